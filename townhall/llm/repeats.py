"""Removal of long passages that occur more than once anywhere in a table, byte for byte.

A byte goes if some string of ``length`` bytes (400, if not told otherwise) that covers it also starts
somewhere else.

1. Every window of ``length`` bytes is filed under its anchor, the leftmost of the least hashes
   of the short strings inside it. Equal windows have equal anchors, so a window whose anchor
   value occurs once is settled. Neighbouring windows with one anchor form one stretch.
2. Equal stretches under one anchor are counted, before any bytes move: those that occur twice
   are repeated as a whole. A hot passage is one stretch with a large count from here on.
3. Where an anchor has different stretches, each is cut into parts by where the anchor lies in the
   window. All windows of a part hold one core of ``length - step + 1`` bytes, and equal windows lie in
   parts with equal cores, so parts whose core occurs once are settled too. Where a core has
   different parts, one of each is sorted: shards of cores get a suffix array by induced sorting
   and permuted common prefixes, which show the windows that two of them share. A core with more
   than ``MOST_PARTS`` different parts is no longer sorted: its windows are counted one by one,
   which is as exact and needs no task to hold them together.
4. Each document's repeated windows are joined and cut out.

Defined results: a null text is empty; matches never cross documents; repeated rows are
documents of their own, so all their texts of ``length`` bytes or more go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from townhall.llm.byte_arrays import WindowHashes, blocks
from townhall.llm.frames import beside_text, id_and_text, row_key, with_text
from townhall.llm.suffix_sort import common_prefixes, suffix_array
from townhall.session import settle

LENGTH = 400
MOST_PARTS = 4096  # different parts of a core that are sorted together
SHARD_BYTES = 2 << 20
_PLACE = np.uint64((1 << 24) - 1)
_PIECE = 1 << 22  # a longer text is filed in pieces that overlap by a window


@dataclass(frozen=True)
class Windows:
    """Length of the strings looked for; of the short strings that anchor them; window starts in a part."""

    length: int = LENGTH
    anchor: int = 64
    step: int = 48

    @classmethod
    def of(cls, length: int) -> Windows:
        return cls(length, max(1, length * 4 // 25), max(1, length * 3 // 25))


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes: the place of the leftmost least one (40 bits compared)."""
    best = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    rest = width - span
    if rest:
        best = np.minimum(best[:-rest], best[rest:])
    return (best & _PLACE).astype(np.int64)


def stretches(data: np.ndarray, starts: np.ndarray, windows: Windows = Windows()) -> tuple[np.ndarray, ...]:
    """Anchor value, row, first and last window start and anchor place (in the block) of each stretch."""
    none = np.zeros(0, np.int64)
    if len(data) < windows.length:
        return none, none, none, none, none
    hashes = WindowHashes(data).every(windows.anchor)
    anchor = _least_places(hashes, windows.length - windows.anchor + 1)
    ends = np.repeat(starts[1:], np.diff(starts))[: len(anchor)]
    whole = np.flatnonzero(np.arange(len(anchor)) + windows.length <= ends)
    if not len(whole):
        return none, none, none, none, none
    held = anchor[whole]
    change = np.flatnonzero(np.diff(held)) + 1
    low = np.concatenate([[0], change])
    high = np.concatenate([change, [len(held)]]) - 1
    first, last = whole[low], whole[high]
    return hashes[held[low]].view(np.int64), np.searchsorted(starts, first, "right") - 1, first, last, held[low]


def _pieces(length: int, batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, byte offset in it, bytes and row starts; texts beyond a piece come alone, cut."""
    for block in blocks(batch, "text"):
        if len(block.data) <= _PIECE:
            yield block.first, 0, block.data, block.starts
        else:  # then the block is one row
            for at in range(0, len(block.data), _PIECE):
                part = block.data[at : at + _PIECE + length - 1]
                yield block.first, at, part, np.array([0, len(part)])


def _file(windows: Windows, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, at, data, starts in _pieces(windows.length, batch):
            anchors, rows, first, last, place = stretches(data, starts, windows)
            if not len(anchors):
                continue
            whole = data.tobytes()
            digests = [hashlib.md5(whole[a : b + windows.length]).digest() for a, b in zip(first.tolist(), last.tolist())]
            begin = starts[rows] - at
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc").take(pa.array(rows + row)), pa.array(anchors),
                    pa.array(digests, pa.binary()), pa.array(first - begin), pa.array(last - begin), pa.array(place - first),
                ],
                names=["doc", "anchor", "stretch", "first", "last", "place"],
            )


def _cut_out(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the asked stretches of each document; a repeated row is asked once in a task."""
    seen = set()
    for batch in batches:
        docs, texts, asked = batch.column("doc"), batch.column("text"), batch.column("asked")
        for row in range(len(batch)):
            if (doc := docs[row].as_py()) in seen:
                continue
            seen.add(doc)
            text, rows = texts[row].as_py().encode(), asked[row].as_py()
            yield pa.RecordBatch.from_pylist(
                [{"anchor": r["anchor"], "stretch": r["stretch"], "n": r["n"], "place": r["place"],
                  "bytes": text[r["first"] : r["last"] + length]} for r in rows],
                schema=_BYTES,
            )


_BYTES = pa.schema([("anchor", pa.int64()), ("stretch", pa.binary()), ("n", pa.int64()), ("place", pa.int64()),
                    ("bytes", pa.binary())])


def parts(place: int, size: int, step: int, length: int = LENGTH) -> Iterator[tuple[int, int, int, int]]:
    """Of a stretch of ``size`` bytes with its anchor at ``place``: first and last window and core of each part."""
    last = size - length
    for j in range((place - last) // step, place // step + 1):
        low, high = max(place - (j + 1) * step + 1, 0), min(place - j * step, last)
        if low <= high:
            yield low, high, place - j * step, place - (j + 1) * step + 1 + length


def _cut_parts(step: int, length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of stretches (or of their windows ``low`` to ``high``): core and digest of each part."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            data, head = r["bytes"], r["anchor"].to_bytes(8, "little", signed=True)
            for low, high, a, b in parts(r["place"], len(data), step, length):
                if r.get("low", low) <= low and high <= r.get("high", high):
                    offset = (r["place"] - low).to_bytes(8, "little")
                    core = hashlib.md5(head + ((r["place"] - a) // step).to_bytes(8, "little", signed=True) + data[a:b])
                    rows.append({"core": core.digest(), "part": hashlib.md5(offset + data[low : high + length]).digest(),
                                 "anchor": r["anchor"], "stretch": r["stretch"], "n": r["n"], "low": low, "high": high})
        yield pa.RecordBatch.from_pylist(rows, schema=_PARTS)


_PARTS = pa.schema([("core", pa.binary()), ("part", pa.binary()), ("anchor", pa.int64()), ("stretch", pa.binary()),
                    ("n", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])
_PARTS_SQL = "core binary, part binary, anchor long, stretch binary, n long, low long, high long"


def repeated_windows(parts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each byte string: the starts of its windows that occur again in this or another string."""
    # 0xFF is in no UTF-8 text: a window that holds it is none
    joined = b"\xff".join(parts) + b"\xff"
    text = np.zeros(len(joined) + 1, np.int16)
    np.add(np.frombuffer(joined, np.uint8), 1, out=text[:-1], dtype=np.int16)  # 0 ends the string and nothing else
    order = suffix_array(text, 257)
    shared = common_prefixes(text, order)
    ends = np.cumsum([len(p) + 1 for p in parts])
    room = np.repeat(ends - 1, np.diff(np.concatenate([[0], ends]))) - np.arange(len(joined))
    with_before = shared >= length
    again = with_before.copy()
    again[order[:-1]] |= with_before[order[1:]]
    again[:-1] &= room >= length
    found = np.flatnonzero(again[:-1])
    begin = ends - [len(p) + 1 for p in parts]
    cuts = np.searchsorted(found, np.concatenate([begin, ends[-1:]]))
    return [found[a:b] - s for a, b, s in zip(cuts[:-1], cuts[1:], begin)]


def _runs(starts: np.ndarray) -> list[int]:
    """Consecutive numbers as first, last, first, last, ..."""
    if not len(starts):
        return []
    breaks = np.flatnonzero(np.diff(starts) > 1)
    return np.column_stack([starts[np.concatenate([[0], breaks + 1])],
                            starts[np.concatenate([breaks, [len(starts) - 1]])]]).ravel().tolist()


def _search(length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort whole cores, a shard of them at a time; rows come sorted by core."""
    held: list[dict] = []
    size = 0

    def shard() -> pa.RecordBatch:
        found = repeated_windows([r["bytes"] for r in held], length)
        rows = [{"anchor": r["anchor"], "stretch": r["stretch"], "runs": _runs(f + r["low"])}
                for r, f in zip(held, found) if r["n"] == 1 and len(f)]
        return pa.RecordBatch.from_pylist(rows, schema=_FOUND)

    for batch in batches:
        for row in batch.to_pylist():
            if size >= SHARD_BYTES and row["core"] != held[-1]["core"]:
                yield shard()
                held, size = [], 0
            held.append(row)
            size += len(row["bytes"])
    if held:
        yield shard()


_FOUND = pa.schema([("anchor", pa.int64()), ("stretch", pa.binary()), ("runs", pa.list_(pa.int64()))])
_FOUND_SQL = "anchor long, stretch binary, runs array<long>"


def _spans(found: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges covered by the repeated windows of a document."""
    ranges = []
    for r in found or []:
        if r["runs"] is None:
            ranges.append((r["first"], r["last"] + length))
        else:
            runs = iter(r["runs"])
            ranges += [(r["first"] + a, r["first"] + b + length) for a, b in zip(runs, runs)]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def _counted(cut: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of parts: (core, part, n, one) and, as found windows, those that occur twice or more."""
    kinds = cut.groupBy("core", "part").agg(
        F.sum("n").alias("n"), F.min(F.struct("anchor", "stretch", "low", "high")).alias("one"))
    kinds = settle(kinds, "parts-counted")
    again = settle(kinds.where("n > 1").select("core", "part"), "parts-again")
    found = cut.where("n = 1").join(again, ["core", "part"]).select(
        "anchor", "stretch", F.array("low", "high").alias("runs"))
    return kinds, found


def _compared(stretches_: DataFrame, windows: Windows) -> DataFrame:
    """Found windows (anchor, stretch, runs) of different stretches (anchor, stretch, n, place, bytes)."""
    length = windows.length
    cut = settle(stretches_.mapInArrow(partial(_cut_parts, windows.step, length), _PARTS_SQL), "parts")
    kinds, found = _counted(cut)
    cores = kinds.groupBy("core").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    cores = settle(cores.where("kinds > 1 and least = 1").select("core", "kinds"), "open-cores")
    few = cores.where(F.col("kinds") <= MOST_PARTS).select("core")
    bytes_of = stretches_.select("anchor", "stretch", "place", "bytes")
    asked = kinds.join(few, "core").select("core", "n", "one.*")
    sorted_ = (
        asked.join(bytes_of, ["anchor", "stretch"])
        .withColumn("bytes", F.expr(f"substring(bytes, cast(low + 1 as int), cast(high - low + {length} as int))"))
        .select("core", "anchor", "stretch", "n", "low", "bytes")
        .repartition("core").sortWithinPartitions("core")
        .mapInArrow(partial(_search, length), _FOUND_SQL)
    )
    # hot cores: every window is a part of its own, and counting settles it
    many = cores.where(F.col("kinds") > MOST_PARTS).select("core")
    single = cut.join(many, "core").select("anchor", "stretch", "n", "low", "high").distinct()
    ones = single.join(bytes_of, ["anchor", "stretch"]).mapInArrow(partial(_cut_parts, 1, length), _PARTS_SQL)
    return found.unionByName(sorted_).unionByName(_counted(settle(ones, "windows"))[1])


def _settled(docs: DataFrame, windows: Windows) -> DataFrame:
    """Rows doc, found: what ``_spans`` needs, for documents with a repeated window."""
    filed = settle(
        docs.select("doc", "text").mapInArrow(
            partial(_file, windows), "doc binary, anchor long, stretch binary, first long, last long, place long"),
        "stretches",
    )
    often = filed.groupBy("anchor").agg(F.count("*").alias("held")).where("held > 1").select("anchor")
    often = settle(often, "often")  # a plain table, so that a join can split an anchor with many holders
    held = settle(filed.join(often, "anchor"), "shared-anchors")
    kinds = held.groupBy("anchor", "stretch").agg(
        F.count("*").alias("n"), F.min(F.struct("doc", "first", "last", "place")).alias("one")
    )
    kinds = settle(kinds, "kinds")
    # comparing is for stretches that occur once beside others; whole repeats are settled already
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
    several = settle(several.where("kinds > 1 and least = 1").select("anchor"), "several")
    asked = kinds.join(several, "anchor").select(
        "one.doc", F.struct("anchor", "stretch", "n", "one.first", "one.last", "one.place").alias("ask")
    ).groupBy("doc").agg(F.collect_list("ask").alias("asked"))
    # repeated rows bring a stretch once a task at most, and only stretches that are settled (n > 1) more than once
    cut = docs.join(asked, "doc").mapInArrow(
        partial(_cut_out, windows.length), "anchor long, stretch binary, n long, place long, bytes binary")
    verdicts = kinds.where("n > 1").select("anchor", "stretch", F.lit(None).cast("array<long>").alias("runs"))
    verdicts = settle(verdicts.unionByName(_compared(settle(cut, "different-stretches"), windows)), "verdicts")
    return (
        held.join(verdicts, ["anchor", "stretch"])
        .groupBy("doc").agg(F.collect_set(F.struct("first", "last", "runs")).alias("found"))  # equal rows have one set
    )


def _remove(as_text: bool, length: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, found = batch.column("text"), batch.column("found")
        rest = [c for c in batch.schema.names if c not in ("text", "found")]
        kept, cuts, sizes = [], [], []
        for row in range(len(batch)):
            text = texts[row].as_py().encode()
            spans = _spans(found[row].as_py(), length)
            at, left = 0, []
            for a, b in spans:
                left.append(text[at:a])
                at = b
            left.append(text[at:])
            whole = b"".join(left)
            kept.append(whole.decode(errors="ignore") if as_text else whole)
            cuts.append([{"start": a, "stop": b} for a, b in spans])
            sizes.append(len(text))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in rest), pa.array(sizes, pa.int64()), pa.array(kept, pa.string() if as_text else pa.binary()),
             pa.array(cuts, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
            names=[*rest, "n_bytes", "kept", "spans"],
        )


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str, as_text: bool = False,
    length: int = LENGTH,
) -> DataFrame:
    """Per row: doc_id, further columns, n_bytes, kept and spans (what went, in bytes).

    ``kept`` holds the bytes left. As text, a character of which only a part is left goes too.
    """
    keyed = id_and_text(docs, id_col, text_col, *more).withColumn("doc", row_key("doc_id", "text"))
    found = _settled(keyed, Windows.of(length))
    kinds = {f.name: f.dataType.simpleString() for f in keyed.schema.fields}
    out = ", ".join(f"`{c}` {kinds[c]}" for c in ("doc_id", *more))
    return keyed.join(found, "doc", "left").select("doc_id", *more, "text", "found").mapInArrow(
        partial(_remove, as_text, length),
        f"{out}, n_bytes long, kept {'string' if as_text else 'binary'}, spans array<struct<start: long, stop: long>>",
    )


def repeat_digest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans and the digest of the bytes left."""
    done = without_repeats(docs)
    return done.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """The table with the repeated passages cut out of its texts; a null text stays null."""
    flat = beside_text(docs, id_col, text_col)
    done = without_repeats(flat, id_col, text_col, "row", as_text=True, length=length)
    return with_text(done, docs.columns, text_col, "kept")
