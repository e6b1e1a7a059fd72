"""Personal data by a skip-chain conditional random field around exact patterns.

Nodes are the tokens of a document that hold a digit or an ``@``; all other tokens carry no
personal data of these kinds by definition and are observed as such. Neighbouring nodes are
linked in a chain. Nodes with equal or similar content, however far apart, share a hub: a hidden
label that each of them tends to agree with. Hubs make the number of links equal to the
number of nodes, so a token that occurs a thousand times has a thousand links and not a million.
Loopy message passing runs until the messages settle.

The exact patterns are evidence: nodes they cover keep their kind, and their spans are always
reported. What the field adds are spans of nodes that no pattern covers but whose context, shape
and likeness to others in the same document make a kind nearly certain.

Weights are learned from the tables themselves. The labels are what the patterns find in a
bounded sample of documents; the pattern is no feature, so the field learns shapes and contexts.

Defined results: a null or empty text has no spans; repeated rows give equal results; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from townhall.llm.frames import beside_text, id_and_text, with_text
from townhall.llm.pii_base import KINDS, MAYBE, base_spans, written

SAMPLE_DOCS = 600  # bound of the training sample, in documents
SAMPLE_NODES = 400  # and of the nodes of each
SEARCHED = 20 * SAMPLE_DOCS  # documents searched for the sample, about
FEATURES = 1 << 13
CERTAIN = 0.9
ROUNDS = 50
AGREE = 8.0  # expected log weight of a link between similar tokens; the sample moves it
MOST_AGREE = 12.0
LABELS = len(KINDS) + 1  # 0: nothing

_SPACE = re.compile(r"\s")
_TRIM = ".,;:!?\"'|#*$%&<>[]{}"


@dataclass
class Nodes:
    """The nodes of a text: spans, whether each follows the one before, features, groups of similar ones."""

    spans: list[tuple[int, int]]
    follows: np.ndarray
    features: list[np.ndarray]
    group: np.ndarray  # -1: alone


def _shape(token: str) -> str:
    kinds = "".join("9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c for c in token)
    return re.sub(r"a+", "a", re.sub(r"A+", "A", kinds[:64]))


def _word(text: str, at: int, step: int) -> str:
    """The neighbouring token's first or last characters, lowered."""
    near = text[max(at - 24, 0) : at] if step < 0 else text[at : at + 24]
    parts = near.split()
    return (parts[-1] if step < 0 else parts[0]).lower() if parts else ""


def _features(text: str, start: int, end: int) -> np.ndarray:
    token = text[start:end]
    shape = _shape(token)
    digits = sum(c.isdigit() for c in token)
    named = (
        "bias", f"s={shape}", f"d={min(digits, 20)}", f"l={min(len(token), 32)}", f"p={shape[:3]}", f"e={shape[-3:]}",
        f"c={token[:1]}", f"at={'@' in token}", f"dots={min(token.count('.'), 5)}",
        f"b={_word(text, start, -1)}", f"f={_word(text, end, 1)}",
    )
    return np.array([zlib.crc32(n.encode()) % FEATURES for n in named])


def _likeness_key(token: str) -> str:
    """Equal for tokens that show the same thing: the last seven digits of a number, which it keeps with or without
    a prefix and however it is grouped; the local part of an address; else letters and digits."""
    name, at, _ = token.rpartition("@")
    if at and len(name := name.strip(_TRIM + "()").lower()) >= 4:
        return name + "@"
    digits = "".join(c for c in token if c.isdigit())
    plain = "".join(c for c in token.lower() if c.isalnum() or c == "@")
    return digits[-7:] if len(digits) >= 4 and 2 * len(digits) >= len(plain) else plain


def find_nodes(text: str, most: int | None = None) -> Nodes:
    spans: list[tuple[int, int]] = []
    at = 0
    while (m := MAYBE.search(text, at)) and (most is None or len(spans) < most):
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        stop = _SPACE.search(text, m.end())
        end = stop.start() if stop else len(text)
        spans.append((start, end))
        at = end
    follows = np.array([k > 0 and not text[spans[k - 1][1] : a].strip() and a - spans[k - 1][1] <= 4
                        for k, (a, _) in enumerate(spans)], bool)
    members: dict[str, list[int]] = {}
    for k, (a, b) in enumerate(spans):
        members.setdefault(_likeness_key(text[a:b]), []).append(k)
    group = np.full(len(spans), -1)
    for number, places in enumerate(p for key, p in members.items() if key and len(p) > 1):
        group[places] = number
    return Nodes(spans, follows, [_features(text, a, b) for a, b in spans], group)


@dataclass
class Weights:
    unary: np.ndarray  # FEATURES x LABELS
    chain: np.ndarray  # LABELS x LABELS
    agree: np.ndarray  # LABELS


def _normal(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


def _through(x: np.ndarray, agree: np.ndarray) -> np.ndarray:
    """A message across a link that rewards equal labels."""
    x = x - x.max(axis=-1, keepdims=True)
    e = np.exp(x)
    return _normal(np.log(e.sum(axis=-1, keepdims=True) + np.expm1(agree) * e))


def propagate(scores: np.ndarray, follows: np.ndarray, group: np.ndarray, w: Weights):
    """Loopy message passing: log marginals of nodes, of chain links, and of agreement with hubs."""
    n = len(scores)
    ahead, back, hub = (np.zeros((n, LABELS)) for _ in range(3))
    second = np.flatnonzero(follows)
    first = second - 1
    tied = np.flatnonzero(group >= 0)
    hubs = int(group.max()) + 1 if len(tied) else 0
    up = np.zeros((n, LABELS))
    total = np.zeros((hubs, LABELS))
    for _ in range(ROUNDS if len(second) or hubs else 0):
        belief = scores + ahead + back + hub
        change = 0.0
        if len(second):
            new = _normal(_lse(belief[first][:, :, None] - back[first][:, :, None] + w.chain, 1))
            change = max(change, np.abs(new - ahead[second]).max())
            ahead[second] = new
            new = _normal(_lse(belief[second][:, None, :] - ahead_before(belief, second, scores, back, hub)[:, None, :]
                               + w.chain, 2))
            change = max(change, np.abs(new - back[first]).max())
            back[first] = new
        if hubs:
            sent = _through((belief - hub)[tied], w.agree)
            sent = _normal(0.5 * sent + 0.5 * up[tied])
            up[tied] = sent
            total[:] = 0
            np.add.at(total, group[tied], sent)
            new = _through(total[group[tied]] - sent, w.agree)
            change = max(change, np.abs(new - hub[tied]).max())
            hub[tied] = new
        if change < 1e-3:
            break
    belief = _normal(scores + ahead + back + hub)
    links = np.zeros((0, LABELS, LABELS))
    if len(second):
        joint = ((belief - back)[first][:, :, None] + (belief - ahead)[second][:, None, :] + w.chain)
        flat = _normal(joint.reshape(len(second), -1))
        links = np.exp(flat).reshape(-1, LABELS, LABELS)
    agreed = np.zeros(LABELS)
    if hubs:
        joint = np.exp(_normal(belief[tied] - hub[tied])) * np.exp(_normal(total[group[tied]] - up[tied]))
        rest = 1 - joint.sum(axis=1, keepdims=True)
        same = joint * np.exp(w.agree)
        agreed = (same / (same.sum(axis=1, keepdims=True) + rest)).sum(axis=0)
    return belief, links, agreed


def ahead_before(belief, second, scores, back, hub) -> np.ndarray:
    """What the chain has brought into nodes so far, taken out of their belief."""
    return (belief - scores - back - hub)[second]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _scores(nodes: Nodes, w: Weights) -> np.ndarray:
    return np.array([w.unary[f].sum(axis=0) for f in nodes.features]).reshape(-1, LABELS)


def _covered(nodes: Nodes, base: list[tuple[int, int, int]]) -> np.ndarray:
    """Label of the pattern that covers at least half of a node, else 0."""
    labels = np.zeros(len(nodes.spans), np.int64)
    starts = np.array([a for a, _ in nodes.spans])
    for kind, a, b in base:
        k = max(int(np.searchsorted(starts, a, "right")) - 1, 0)
        while k < len(nodes.spans) and nodes.spans[k][0] < b:
            low, high = nodes.spans[k]
            if 2 * (min(b, high) - max(a, low)) >= high - low:
                labels[k] = kind + 1
            k += 1
    return labels


def train(texts: list[str], epochs: int = 4) -> Weights:
    """Gradient steps on the likelihood that message passing approximates; texts in their order."""
    w = Weights(np.zeros((FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.full(LABELS, AGREE))
    seen = [np.full_like(x, 1e-6) for x in (w.unary, w.chain)]
    examples = []
    for text in texts:
        nodes = find_nodes(text, SAMPLE_NODES)
        if nodes.spans:
            examples.append((nodes, _covered(nodes, base_spans(text))))

    def step(x: np.ndarray, grad: np.ndarray, past: np.ndarray) -> None:
        past += grad * grad
        x += 0.3 * grad / np.sqrt(past)

    for _ in range(epochs):
        for nodes, labels in examples:
            scores = _scores(nodes, w)
            belief, links, agreed = propagate(scores, nodes.follows, nodes.group, w)
            clamped = np.where(np.arange(LABELS) == labels[:, None], 0.0, -40.0)
            _, fixed, fixed_agreed = propagate(clamped, nodes.follows, nodes.group, w)
            error = np.eye(LABELS)[labels] - np.exp(belief)
            used = np.concatenate(nodes.features)
            rows, inverse = np.unique(used, return_inverse=True)
            grad = np.zeros((len(rows), LABELS))
            np.add.at(grad, inverse, np.repeat(error, [len(f) for f in nodes.features], axis=0))
            seen[0][rows] += grad * grad
            w.unary[rows] += 0.3 * grad / np.sqrt(seen[0][rows])
            if len(links):
                step(w.chain, fixed.sum(axis=0) - links.sum(axis=0), seen[1])
            if nodes.group.max() >= 0:
                w.agree += 0.02 * (fixed_agreed - agreed + AGREE - w.agree)
                np.clip(w.agree, 0.0, MOST_AGREE, out=w.agree)
    return w


def all_spans(text: str, w: Weights) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The patterns' spans, and the spans the field adds to them."""
    base = base_spans(text)
    nodes = find_nodes(text) if MAYBE.search(text) else None
    if nodes is None or not nodes.spans:
        return base, []
    labels = _covered(nodes, base)
    scores = _scores(nodes, w)
    scores[labels > 0] = np.where(np.arange(LABELS) == labels[labels > 0][:, None], 0.0, -40.0)
    belief = np.exp(propagate(scores, nodes.follows, nodes.group, w)[0])
    top = belief.argmax(axis=1)
    sure = (top > 0) & (labels == 0) & (belief.max(axis=1) >= CERTAIN)
    taken = sorted((a, b) for _, a, b in base)
    starts, ends = np.array([a for a, _ in taken]), np.array([b for _, b in taken])
    added: list[tuple[int, int, int]] = []
    for k in np.flatnonzero(sure).tolist():
        a, b = nodes.spans[k]
        while a < b and text[a] in _TRIM:
            a += 1
        while b > a and text[b - 1] in _TRIM:
            b -= 1
        if a >= b or (len(taken) and bool(((starts < b) & (ends > a)).any())):
            continue
        kind = int(top[k]) - 1
        if added and added[-1][0] == kind and nodes.follows[k] and sure[k - 1] and added[-1][2] <= a:
            added[-1] = (kind, added[-1][1], b)
        else:
            added.append((kind, a, b))
    return base, [s for s in added if _could_be(s[0], text[s[1] : s[2]])]


def _could_be(kind: int, found: str) -> bool:
    """Whether a span holds what its kind cannot do without; a year is no telephone number."""
    digits = sum(c.isdigit() for c in found)
    name = KINDS[kind]
    if name == "email":
        return "@" in found
    if name == "ip":
        return found.count(".") >= 3 and digits >= 4
    return digits >= (13 if name == "card" else 7)


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Weights:
    """Weights from at most SAMPLE_DOCS documents with a pattern in them, the least by a hash.

    A threshold on the hash first leaves about SEARCHED documents of a table of any size, so
    no more than those are looked at and few rows reach the driver.
    """
    plain = id_and_text(docs, id_col, text_col)
    part = min(1.0, SEARCHED / max(plain.count(), 1))
    mark = F.pmod(F.xxhash64("text"), F.lit(1 << 32))
    some = plain.select(mark.alias("mark"), "text").where(F.col("mark") < int(part * (1 << 32)))
    excerpts = some.mapInArrow(_excerpts, "mark long, text string")
    rows = excerpts.orderBy("mark", "text").limit(SAMPLE_DOCS).collect()
    return train([r["text"] for r in rows])


def _excerpts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with a pattern as the text around their nodes; what is further away is no feature."""
    for batch in batches:
        marks, texts = [], []
        for mark, text in zip(batch.column("mark").to_pylist(), batch.column("text").to_pylist()):
            if not base_spans(text):
                continue
            parts, done = [], 0
            for a, b in find_nodes(text, SAMPLE_NODES).spans:
                parts.append(text[max(a - 24, done) : b + 24])
                done = b + 24
            texts.append("  \n  ".join(parts) if len(text) > 4000 else text)
            marks.append(mark)
        yield pa.RecordBatch.from_arrays([pa.array(marks, pa.int64()), pa.array(texts, pa.string())],
                                         names=["mark", "text"])


_SPAN = "array<struct<kind: string, start: long, end: long>>"


def _find(w: Weights, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        base_all, added_all = [], []
        for text in batch.column("text").to_pylist():
            base, added = all_spans(text, w)
            for spans, out in ((base, base_all), (added, added_all)):
                out.append([{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(spans)])
        rest = [c for c in batch.schema.names]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in rest), pa.array(base_all, kind), pa.array(added_all, kind)],
            names=[*rest, "base", "added"],
        )


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Per row: doc_id, text, further columns, base and added (kind, start, end in characters)."""
    w = learn(docs, id_col, text_col)
    plain = id_and_text(docs, id_col, text_col, *more)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(partial(_find, w), f"{kinds}, base {_SPAN}, added {_SPAN}")


def _digest(w: Weights, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _find(w, batches):
        n, digests, spans = [[] for _ in KINDS], [], []
        for base, added in zip(batch.column("base").to_pylist(), batch.column("added").to_pylist()):
            own = [(KINDS.index(s["kind"]), s["start"], s["end"]) for s in base]
            for k, out in enumerate(n):
                out.append(sum(s[0] == k for s in own))
            digests.append(hashlib.sha256(written(own).encode()).hexdigest())
            spans.append(written(own + [(KINDS.index(s["kind"]), s["start"], s["end"]) for s in added]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in n), pa.array(digests, pa.string()),
             pa.array(spans, pa.string())],
            names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
        )


def span_digest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts by kind and a digest of the patterns' spans, and all spans as text."""
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    plain = id_and_text(docs)
    return plain.mapInArrow(partial(_digest, learn(docs)), f"doc_id long, {counts}, base_sha256 string, spans string")


def _mask(w: Weights, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _find(w, batches):
        out = []
        for text, base, added in zip(*(batch.column(c).to_pylist() for c in ("text", "base", "added"))):
            parts, at = [], 0
            for s in sorted(base + added, key=lambda s: (s["start"], -s["end"])):
                if s["end"] <= at:
                    continue
                if s["start"] >= at:
                    parts += [text[at : s["start"]], f"<{s['kind']}>"]
                at = s["end"]
            out.append("".join(parts) + text[at:])
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], names=["row", "masked"])


def mask_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The table with every span replaced by its kind in angle brackets; a null text stays null."""
    flat = beside_text(docs, id_col, text_col)
    kind = flat.schema["row"].dataType.simpleString()
    plain = id_and_text(flat, id_col, text_col, "row").select("row", "text")
    done = plain.mapInArrow(partial(_mask, learn(flat, id_col, text_col)), f"row {kind}, masked string")
    return with_text(done, docs.columns, text_col, "masked")
