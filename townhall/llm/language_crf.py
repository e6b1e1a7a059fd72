"""Language identification: a linear-chain conditional random field over the words of a text.

Every word gets a label; neighbouring words tend to share one, as far as the learned transitions
say, so switches inside a text are found where they happen. Scores of a word come from hashed
character n-grams (those at its edges are its affixes) and from its whole form (the lexicon).
Forward-backward over all words of all texts of a block runs in step: the n-th words of all texts
at once. A text's language is the label with the most letters, by marginals.

Weights are learned from labelled rows of the table. A hash picks about SEARCHED of each label, all
of a rare one; each label gives the least SAMPLE_DOCS of them by that hash, and each row at most SAMPLE_CHARS characters
from a place that the hash chooses. Sequences for training switch between rows, so transitions
are learned.

Defined results: a null text, or one without a letter, is ``und`` with score 0; rows without id
are neither held out nor learned from; ties go to the first label in order; a table without
labelled rows predicts ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from townhall.llm.byte_arrays import BLOCK_BYTES, Block, WindowHashes, blocks

SAMPLE_DOCS = 400  # of each label
SAMPLE_CHARS = 1500  # of each document
SEARCHED = 4 * SAMPLE_DOCS  # rows of each label looked through for them, about
SIZES = (2, 3, 4)
BUCKETS = 1 << 16  # for n-grams, and as many for whole words
EPOCHS = 4
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")

_KIND = np.full(256, 32, np.uint8)  # what is no letter counts as a gap
for _c in [*range(65, 91), *range(97, 123), *range(128, 256)]:
    _KIND[_c] = _c
_KIND[65:91] += 32


def _lowered(data: np.ndarray) -> np.ndarray:
    """Letters in lower case (ASCII and Latin-1), anything else a gap; UTF-8 stays UTF-8.

    Of what lies beyond ASCII, the signs of Latin-1 and of general punctuation are gaps, the rest counts as letters.
    """
    out = _KIND[data]
    signs = np.flatnonzero((out[:-1] == 0xC2) & ~np.isin(out[1:], [0xAA, 0xB5, 0xBA])) + 1
    marks = np.flatnonzero((out[:-2] == 0xE2) & ((out[1:-1] == 0x80) | (out[1:-1] == 0x81))) + 2
    signs_and_marks = np.concatenate([signs - 1, signs, marks - 2, marks - 1, marks])
    upper = np.flatnonzero((out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E)) + 1
    out[upper] += 0x20
    out[signs_and_marks] = 32
    return out


@dataclass
class Words:
    """The words of a block: letters of each, row of each, and the text with a gap around every word."""

    text: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray


def split(block: Block) -> Words:
    n = block.last - block.first
    # a gap before every row and after the last keeps words of neighbours apart
    at = block.starts[:-1] + np.arange(n)
    text = np.full(len(block.data) + n + 1, 32, np.uint8)
    keep = np.ones(len(text), bool)
    keep[at] = False
    keep[-1] = False
    text[keep] = _lowered(block.data) if len(block.data) else block.data
    gap = text == 32
    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    return Words(text, starts, ends, np.searchsorted(at, starts, "right") - 1)


def _gram(text: np.ndarray, size: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each place."""
    code = np.zeros(len(text) - size + 1, np.uint32)
    for k in range(size):
        code = code * np.uint32(0x01000193) ^ text[k : k + len(code)]
    code = (code ^ np.uint32(size)) * np.uint32(0x9E3779B1)
    return (code >> np.uint32(16)).astype(np.int64)


def _whole(words: Words) -> np.ndarray:
    hashes = WindowHashes(words.text).at(words.starts, words.ends - words.starts)
    return BUCKETS + (hashes >> np.uint64(48)).astype(np.int64)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # (2 * BUCKETS) x labels, float32
    moves: np.ndarray  # labels x labels, log


def scores(words: Words, model: Model) -> np.ndarray:
    """Sum of the weights of all features of each word."""
    out = model.weights[_whole(words)].astype(np.float64)
    for size in SIZES:
        if len(words.text) < size:
            continue
        weight = model.weights[_gram(words.text, size)]
        total = np.zeros((len(weight) + 1, len(model.labels)))
        np.cumsum(weight, axis=0, dtype=np.float64, out=total[1:])
        low = words.starts - 1
        high = np.maximum(words.ends + 1 - size + 1, low)  # with the gaps on both sides
        out += total[np.minimum(high, len(weight))] - total[np.minimum(low, len(weight))]
    return out


def marginals(score: np.ndarray, bounds: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Forward-backward over sequences ``bounds[k]`` to ``bounds[k + 1]``, all in step."""
    lengths = np.diff(bounds)
    order = np.argsort(-lengths, kind="stable")
    lengths, first = lengths[order], bounds[:-1][order]
    emit = np.exp(score - score.max(axis=1, keepdims=True)) if len(score) else score
    step = np.exp(moves - moves.max())
    ahead = np.empty_like(emit)
    open_ = len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0] if len(lengths) else 0), "right")
    state = None
    for t, active in enumerate(open_):
        at = first[:active] + t
        state = emit[at] if state is None else (state[:active] @ step) * emit[at]
        state /= state.sum(axis=1, keepdims=True)
        ahead[at] = state
    back = np.ones((len(lengths), emit.shape[1]))
    for t in range(len(open_) - 2, -1, -1):
        active = open_[t + 1]
        at = first[:active] + t + 1
        later = (back[:active] * emit[at]) @ step.T
        back[:active] = later / later.sum(axis=1, keepdims=True)
        ahead[at - 1] *= back[:active]
    return ahead / np.maximum(ahead.sum(axis=1, keepdims=True), 1e-300)


def _features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """All features of all words, and where each word's begin."""
    parts, owners = [_whole(words)], [np.arange(len(words.starts))]
    for size in SIZES:
        grams = _gram(words.text, size)
        count = np.maximum(words.ends - words.starts + 2 - size + 1, 0)
        owner = np.repeat(np.arange(len(count)), count)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        parts.append(grams[words.starts[owner] - 1 + nth])
        owners.append(owner)
    owner = np.concatenate(owners)
    by = np.argsort(owner, kind="stable")
    return np.concatenate(parts)[by], np.searchsorted(owner[by], np.arange(len(words.starts) + 1))


def train(rows: list[tuple[str, str]], seed: int = 11) -> Model | None:
    """From (language, text) rows in their order; gradient steps on the chain's likelihood."""
    labels = sorted({lang for lang, _ in rows})
    if not labels:
        return None
    rng = np.random.default_rng(seed)
    model = Model(labels, np.zeros((2 * BUCKETS, len(labels)), np.float32), np.eye(len(labels)) * 2.0)
    texts = [text.encode() for _, text in rows]
    starts = np.cumsum([0] + [len(t) for t in texts])
    words = split(Block(0, len(texts), np.frombuffer(b"".join(texts), np.uint8), starts))
    features, begin = _features(words)
    truth = np.array([labels.index(lang) for lang, _ in rows])[words.rows]
    cuts = np.searchsorted(words.rows, np.arange(len(rows) + 1))
    chunks = [np.arange(a, min(a + 12, b)) for lo, b in zip(cuts[:-1], cuts[1:]) for a in range(lo, b, 12)]
    past_w, past_m = np.full_like(model.weights, 1e-4), np.full_like(model.moves, 1e-4)
    one = np.eye(len(labels))
    for _ in range(EPOCHS if len(words.starts) else 0):
        # sequences of a few chunks from different rows, each a run of one language
        mixed = [chunks[k] for k in rng.permutation(len(chunks))]
        for low in range(0, len(mixed), 256):
            part = mixed[low : low + 256]
            picked = np.concatenate(part)
            ends = np.cumsum([len(p) for p in part])
            bounds = np.unique(np.concatenate([[0], ends[3::4], ends[-1:]]))
            count = begin[picked + 1] - begin[picked]
            owner = np.repeat(np.arange(len(picked)), count)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            used = features[begin[picked][owner] + nth]
            score = np.zeros((len(picked), len(labels)))
            np.add.at(score, owner, model.weights[used])
            expected = marginals(score, bounds, model.moves)
            error = one[truth[picked]] - expected
            inner = np.setdiff1d(np.arange(len(picked)), bounds[:-1])
            pair = expected[inner - 1][:, :, None] * expected[inner][:, None, :] * np.exp(model.moves)
            pair /= pair.sum(axis=(1, 2), keepdims=True)
            seen = np.zeros_like(model.moves)
            np.add.at(seen, (truth[picked][inner - 1], truth[picked][inner]), 1.0)
            grad = np.zeros((len(np.unique(used)), len(labels)))
            rows_used, inverse = np.unique(used, return_inverse=True)
            np.add.at(grad, inverse, error[owner])
            past_w[rows_used] += grad**2
            model.weights[rows_used] += 0.2 * grad / np.sqrt(past_w[rows_used])
            move = (seen - pair.sum(axis=0)) / max(len(inner), 1)
            past_m += move**2
            model.moves += 0.1 * move / np.sqrt(past_m)
    return model


def _predict(model: Model | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, shares = [], []
        for block in blocks(batch, "text", 4 * BLOCK_BYTES):
            size = block.last - block.first
            lettered = [bool(_LETTER.search(t.as_py())) for t in batch.column("text").slice(block.first, size)]
            if model is None or not any(lettered):
                langs += [UNKNOWN] * size
                shares += [0.0] * size
                continue
            words = split(block)
            found = marginals(scores(words, model), np.searchsorted(words.rows, np.arange(size + 1)), model.moves)
            mass = np.zeros((size, len(model.labels)))
            np.add.at(mass, words.rows, found * (words.ends - words.starts)[:, None])
            top, total = mass.argmax(axis=1), mass.sum(axis=1)
            for k in range(size):
                sure = lettered[k] and total[k] > 0
                langs.append(model.labels[top[k]] if sure else UNKNOWN)
                shares.append(min(1.0, float(mass[k, top[k]] / total[k])) if sure else 0.0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()),
             pa.array(shares, pa.float64())],
            names=["doc_id", "held_out", "lang_pred", "score"],
        )


def held_out(id_: Column) -> Column:
    """A fifth of the documents, by the CRC-32 of the id as text."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> Model | None:
    """A model from the labelled rows that are not held out."""
    mark = F.xxhash64(F.col(f"`{id_col}`"), F.lit(42))
    text = F.col(f"`{text_col}`")
    begin = F.pmod(mark, F.greatest(F.length(text) - SAMPLE_CHARS, F.lit(1)).cast("long")).cast("int") + 1
    labelled = docs.where(
        F.col(f"`{label_col}`").isNotNull() & text.isNotNull() & F.col(f"`{id_col}`").isNotNull()
        & ~held_out(F.col(f"`{id_col}`"))
    )
    labelled = labelled.select(
        F.col(f"`{label_col}`").alias("lang"), mark.alias("mark"), F.pmod(mark, F.lit(1 << 32)).alias("low"),
        F.substring(text, begin, F.lit(SAMPLE_CHARS)).alias("excerpt"))
    # a threshold on the hash for each label leaves about as many rows of it in a table of any size, and never none;
    # a model has a column of weights for each label, so labels are few
    part = F.least(F.lit(1.0), SEARCHED / F.count("*"))
    most = labelled.groupBy(F.col("lang").alias("label")).agg(
        F.greatest((part * (1 << 32)).cast("long"), F.min("low") + 1).alias("most"))
    labelled = labelled.join(F.broadcast(most), (F.col("lang") == F.col("label")) & (F.col("low") < F.col("most")))
    order = Window.partitionBy("lang").orderBy("mark", "excerpt")
    rows = labelled.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= SAMPLE_DOCS).collect()
    return train([(r["lang"], r["excerpt"]) for r in sorted(rows, key=lambda r: (r["lang"], r["nth"]))])


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred and score."""
    model = learn(docs, id_col, text_col, label_col)
    plain = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), held_out(F.col(f"`{id_col}`")).alias("held_out"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    return plain.mapInArrow(partial(_predict, model), "doc_id long, held_out boolean, lang_pred string, score double")


def label_words(text: str, model: Model) -> list[tuple[int, int, str]]:
    """Of one text: byte range and language of each word, by forward-backward."""
    data = np.frombuffer(text.encode(), np.uint8)
    words = split(Block(0, 1, data, np.array([0, len(data)])))
    found = marginals(scores(words, model), np.array([0, len(words.starts)]), model.moves)
    return [(int(a) - 1, int(b) - 1, model.labels[k]) for a, b, k in zip(words.starts, words.ends, found.argmax(axis=1))]
