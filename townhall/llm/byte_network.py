"""Quality of texts by a small convolutional network over their bytes, in numpy.

Bytes are embedded; filters of ``WIDTH`` bytes look at every ``STRIDE``-th place. Outputs are pooled by their
maximum within chunks of two blocks, and each block belongs to two chunks, so chunks overlap by half and cover the
whole text, whatever its length. A chunk's maxima go through a hidden layer; the mean of the hidden values of all
chunks gives one probability. Texts are worked through in runs of bounded size that carry on inside a long text, so
memory does not grow with the text.

Learned from at most ``SAMPLE_DOCS`` rows of each label (0 and 1), found by a hash among the rows that are not held out,
each by ``EXCERPTS`` excerpts of at most ``EXCERPT_CHARS`` characters spread evenly over it. Both labels weigh alike
in training. Seeds are fixed and rows sorted, so a table always gives the same model.

Defined results: null and empty texts are one chunk of padding and have a score like any other; rows without id are
neither held out nor learned from; where a document has several labels each counts; without labels of both
kinds every score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from townhall.llm.byte_arrays import blocks
from townhall.llm.frames import id_and_text
from townhall.session import settle

SAMPLE_DOCS = 1000  # of each label
EXCERPTS, EXCERPT_CHARS = 3, 1000
STRIDE, WIDTH = 4, 8
EMBED, FILTERS, HIDDEN = 8, 32, 16
BLOCK = 256  # bytes; a chunk is two blocks
RUN = 1 << 20  # bytes worked through at once
EPOCHS, BATCH, RATE = 16, 64, 1e-2
_PLACES = BLOCK // STRIDE


@dataclass
class Network:
    embed: np.ndarray  # 256 x EMBED; byte 0 stands for padding too
    near: np.ndarray  # filters on the first STRIDE bytes of a place
    far: np.ndarray  # and on the next
    bias: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    share: np.ndarray  # intercept

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.near, self.far, self.bias, self.hidden, self.hidden_bias, self.out, self.share]


def fresh(seed: int = 5) -> Network:
    rng = np.random.default_rng(seed)

    def drawn(*shape: int) -> np.ndarray:
        return (rng.standard_normal(shape) / math.sqrt(shape[0])).astype(np.float32)

    embed = rng.standard_normal((256, EMBED)).astype(np.float32) * np.float32(0.5)
    wide = drawn(WIDTH * EMBED, FILTERS)
    return Network(
        embed, wide[: STRIDE * EMBED].copy(), wide[STRIDE * EMBED :].copy(), np.zeros(FILTERS, np.float32),
        drawn(FILTERS, HIDDEN), np.zeros(HIDDEN, np.float32), drawn(HIDDEN), np.zeros(1, np.float32))


def n_blocks(size: int) -> int:
    """Blocks of a text of ``size`` bytes with at least STRIDE bytes of padding behind it."""
    return -(-(size + STRIDE) // BLOCK)


def _places(net: Network, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedded steps of STRIDE bytes, and the filters' outputs at all of them but the last."""
    steps = net.embed[data].reshape(-1, STRIDE * EMBED)
    out = steps[:-1] @ net.near
    out += steps[1:] @ net.far
    return steps, out


def block_maxima(net: Network, data: np.ndarray) -> np.ndarray:
    """Maximum of each filter in each block of ``data``: whole blocks and one step behind them."""
    out = _places(net, data)[1]
    return out.reshape(-1, _PLACES, FILTERS).max(axis=1)


def chunk_values(net: Network, maxima: np.ndarray) -> np.ndarray:
    """Hidden values of chunks from the maxima of two blocks."""
    pooled = np.maximum(maxima + net.bias, 0)
    return np.maximum(pooled @ net.hidden + net.hidden_bias, 0)


def _probability(net: Network, mean: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(mean.astype(np.float64) @ net.out + net.share[0], -30, 30)))


def text_score(net: Network, text: np.ndarray) -> float:
    """Of one text's bytes, a run at a time."""
    total, chunks, before = np.zeros(HIDDEN, np.float64), 0, None
    count = n_blocks(len(text))
    per_run = RUN // BLOCK
    for low in range(0, count, per_run):
        high = min(low + per_run, count)
        data = np.zeros((high - low) * BLOCK + STRIDE, np.uint8)
        part = text[low * BLOCK : low * BLOCK + len(data)]
        data[: len(part)] = part
        maxima = block_maxima(net, data)
        if before is not None:
            maxima = np.concatenate([before, maxima])
        values = chunk_values(net, np.maximum(maxima[:-1], maxima[1:]) if len(maxima) > 1 else maxima[:0])
        total += values.sum(axis=0, dtype=np.float64)
        chunks += len(values)
        before = maxima[-1:]
    if not chunks:  # a text of one block is one chunk
        total, chunks = chunk_values(net, before)[0].astype(np.float64), 1
    return float(_probability(net, total / chunks))


def text_scores(net: Network, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of texts that lie end to end, together at most about a run."""
    sizes = np.diff(starts)
    counts = -(-(sizes + STRIDE) // BLOCK)
    first = np.concatenate([[0], np.cumsum(counts)])
    padded = np.zeros(first[-1] * BLOCK + STRIDE, np.uint8)
    shift = np.repeat(first[:-1] * BLOCK - starts[:-1], sizes)
    padded[np.arange(len(data)) + shift] = data
    out = _places(net, padded)[1]
    # the last place of a text would see the next one's first bytes: it sees padding instead
    last = first[1:] * _PLACES - 1
    zero = np.tile(net.embed[0], STRIDE)
    out[last] = zero @ net.near + zero @ net.far
    maxima = out.reshape(-1, _PLACES, FILTERS).max(axis=1)
    pairs = np.maximum(maxima, np.concatenate([maxima[1:], maxima[-1:]]))
    chunks = np.maximum(counts - 1, 1)
    begin = np.concatenate([[0], np.cumsum(chunks)])
    at = np.repeat(first[:-1] - begin[:-1], chunks) + np.arange(begin[-1])
    alone = np.repeat(counts == 1, chunks)
    pooled = np.where(alone[:, None], maxima[at], pairs[at])
    values = chunk_values(net, pooled)
    mean = np.add.reduceat(values, begin[:-1], axis=0, dtype=np.float64) / chunks[:, None]
    return _probability(net, mean)


def _gradients(net: Network, data: np.ndarray, owner: np.ndarray, counts: np.ndarray, truth: np.ndarray,
               weight: np.ndarray) -> list[np.ndarray]:
    """Of the weighted log-loss. ``data``: chunks of two blocks and a step each, as rows; ``owner``: the text of each."""
    n, places = len(data), 2 * _PLACES
    steps = net.embed[data].reshape(n, places + 1, STRIDE * EMBED)
    out = steps[:, :-1] @ net.near + steps[:, 1:] @ net.far
    top = out.argmax(axis=1)
    pooled = np.take_along_axis(out, top[:, None, :], axis=1)[:, 0] + net.bias
    active = np.maximum(pooled, 0)
    inner = active @ net.hidden + net.hidden_bias
    values = np.maximum(inner, 0)
    mean = np.zeros((len(truth), HIDDEN), np.float32)
    np.add.at(mean, owner, values)
    mean /= counts[:, None]
    error = ((_probability(net, mean) - truth) * weight).astype(np.float32)
    g_out, g_share = mean.T @ error, np.array([error.sum()], np.float32)
    g_values = (error[:, None] * net.out / counts[:, None])[owner] * (inner > 0)
    g_hidden, g_hidden_bias = active.T @ g_values, g_values.sum(axis=0)
    g_pooled = (g_values @ net.hidden.T) * (pooled > 0)
    # only the winning place of each filter and chunk has a gradient
    rows = np.arange(n)[:, None]
    seen_near, seen_far = steps[rows, top], steps[rows, top + 1]  # n x filters x step
    g_near = np.einsum("nfs,nf->sf", seen_near, g_pooled)
    g_far = np.einsum("nfs,nf->sf", seen_far, g_pooled)
    g_embed = np.zeros_like(net.embed)
    at = top[:, :, None] * STRIDE + np.arange(WIDTH)
    used = data[rows[:, :, None], at]  # n x filters x WIDTH
    wide = np.concatenate([net.near, net.far]).T.reshape(FILTERS, WIDTH, EMBED)
    np.add.at(g_embed, used.ravel(), (g_pooled[:, :, None, None] * wide).reshape(-1, EMBED))
    return [g_embed, g_near, g_far, g_pooled.sum(axis=0), g_hidden, g_hidden_bias, g_out, g_share]


def _chunks(text: bytes) -> np.ndarray:
    """All overlapping chunks of a text, as rows, each with the step behind it."""
    count = n_blocks(len(text))
    data = np.zeros(max(count, 2) * BLOCK + STRIDE, np.uint8)
    data[: len(text)] = np.frombuffer(text, np.uint8)
    wide = 2 * BLOCK + STRIDE
    return np.lib.stride_tricks.sliding_window_view(data, wide)[:: BLOCK][: max(count - 1, 1)]


def train(rows: list[tuple[int, list[str]]], seed: int = 5) -> Network | None:
    """From (label, excerpts) in their order, by Adam; None without both labels."""
    truth = np.array([label for label, _ in rows], np.float64)
    if not 0 < truth.sum() < len(truth):
        return None
    rng = np.random.default_rng(seed)
    net = fresh(seed)
    texts = [np.concatenate([_chunks(e.encode()) for e in excerpts]) for _, excerpts in rows]
    positive = truth.mean()
    weight = np.where(truth > 0, 0.5 / positive, 0.5 / (1 - positive))
    first = [np.zeros_like(w) for w in net.weights()]
    second = [np.zeros_like(w) for w in net.weights()]
    steps = EPOCHS * -(-len(rows) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for low in range(0, len(order), BATCH):
            picked = order[low : low + BATCH]
            counts = np.array([len(texts[k]) for k in picked])
            grads = _gradients(
                net, np.concatenate([texts[k] for k in picked]), np.repeat(np.arange(len(picked)), counts),
                counts.astype(np.float32), truth[picked], weight[picked] / len(picked))
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for w, g, a, b in zip(net.weights(), grads, first, second):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                w -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def _score(net: Network | float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for block in blocks(batch, "text", RUN):
            if isinstance(net, float):
                found.append(np.full(block.last - block.first, net))
            elif block.last - block.first == 1:
                found.append(np.array([text_score(net, block.data)]))
            else:
                found.append(text_scores(net, block.data, block.starts))
        scores = np.concatenate(found) if found else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
             pa.array((scores >= 0.5).astype(np.int32), pa.int32())],
            names=["doc_id", "held_out", "score", "predicted"])


def held_out(id_: Column) -> Column:
    """A third of the documents, by the CRC-32 of the id as text."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _excerpts(text: Column) -> Column:
    room = F.greatest(F.length(text) - EXCERPT_CHARS, F.lit(0))
    # a text that one excerpt holds is taken once
    return F.when(room == 0, F.array(text)).otherwise(F.array(*[
        F.substring(text, F.floor(room * k / (EXCERPTS - 1)).cast("int") + 1, F.lit(EXCERPT_CHARS)) for k in range(EXCERPTS)]))


def learn(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> Network | float:
    """A network from labelled rows that are not held out; without both labels the share of label 1.

    ``docs`` holds doc_id and text. The rows of a label are chosen in the table of labels, by a threshold on the id's hash that
    leaves about ``SAMPLE_DOCS`` of them in a table of any size, and all where there are fewer.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.withColumn("mark", F.pmod(F.xxhash64("doc_id", F.lit(42)), F.lit(1 << 32)))
    sizes = {r["label"]: r["held"] for r in known.groupBy("label").agg(F.count("*").alias("held")).collect()}
    if len(sizes) < 2:
        return float(max(sizes, default=0.5))
    most = {k: int(min(1.0, 1.25 * SAMPLE_DOCS / n) * (1 << 32)) for k, n in sizes.items()}
    chosen = known.where(F.when(F.col("label") == 0, F.col("mark") < most[0]).otherwise(F.col("mark") < most[1]))
    # no more than about 1.25 * SAMPLE_DOCS rows of each label, whatever the table's size
    chosen = settle(chosen, "labelled")
    pieces = docs.join(F.broadcast(chosen), "doc_id").select("label", "mark", _excerpts(F.col("text")).alias("excerpts"))
    order = Window.partitionBy("label").orderBy("mark", "excerpts")
    rows = pieces.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= SAMPLE_DOCS).collect()
    net = train([(r["label"], r["excerpts"]) for r in sorted(rows, key=lambda r: (r["label"], r["nth"]))])
    if net is None:  # labels of documents that the table does not hold
        return sizes[1] / (sizes[0] + sizes[1])
    return net


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> DataFrame:
    """Per row: doc_id, held_out, score and predicted."""
    plain = id_and_text(docs, id_col, text_col)
    net = learn(plain, labels, label_col)
    return plain.withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(
        partial(_score, net), "doc_id long, held_out boolean, score double, predicted int")
