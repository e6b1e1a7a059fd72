"""Near-duplicate groups: SuperMinHash signatures, banding, exact confirmation, grouping.

Each distinct word sequence is one node. A node's set holds its distinct five-word shingles.
SuperMinHash gives every shingle its own random permutation of the signature's places: in
round ``j`` a shingle offers a value in ``[j, j + 1)`` to the ``j``-th place of its permutation,
and the rounds stop once every place holds a value no later round can beat.

Signatures are cut into bands. Within a bucket of equal bands every member is confirmed against
one pivot on the full sets. Members that are not linked to their pivot may be linked to each
other; their differences to the pivot are joined by a prefix filter that misses no such link and
lets independent edits of one text apart. So a bucket costs about as many confirmations as it
has members. Banding itself misses a pair at exactly the threshold with probability 5e-6.

Defined results: a null or empty text, or one of white space only, has an empty set and stays
alone; repeated rows are copies of one another; rows with a null id take part, their group's
number is the smallest id in it (null if there is none); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from townhall.llm.byte_arrays import Block, blocks, mix, words
from townhall.llm.components import connected
from townhall.llm.frames import id_and_text
from townhall.session import settle

SHINGLE = 5
PERCENT = 75
BANDS, BAND_ROWS = 32, 4

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1
_VALUE = np.uint64((1 << 56) - 1)
_UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)


def _rank_places(keys: np.ndarray, round_: int, left: int) -> tuple[np.ndarray, np.ndarray]:
    """For each shingle in a round: a place among those left, and a 56-bit fraction."""
    drawn = mix(keys + np.uint64(int(_STEP) * (2 * round_ + 1) & _MASK))
    return (mix(drawn) >> np.uint64(32)) % np.uint64(left), drawn & _VALUE


def signature(shingles: np.ndarray, places: int) -> np.ndarray:
    """SuperMinHash of a set of distinct 64-bit shingles; places beyond reach stay at the maximum."""
    best = np.full(places, _UNSET, np.uint64)
    if not len(shingles):
        return best
    order = None
    each = np.arange(len(shingles))
    for j in range(places):
        pick, value = _rank_places(shingles, j, places - j)
        pick = pick.astype(np.int64) + j
        if j == 1:  # permutations are only written down for sets that need a second round
            first, _ = _rank_places(shingles, 0, places)
            order = np.broadcast_to(np.arange(places, dtype=np.int32), (len(shingles), places)).copy()
            order[each, first.astype(np.int64)] = 0
            order[:, 0] = first
        if order is None:
            place = pick
        else:
            place = order[each, pick]
            order[each, pick] = order[:, j]
            order[:, j] = place
        np.minimum.at(best, place, value | np.uint64(j << 56))
        if int(best.max() >> np.uint64(56)) <= j:
            break
    return best


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sig.reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64) * _STEP
    for column in range(rows):
        key = mix(key ^ parts[:, column]) * np.uint64(0xD1342543DE82EF95)
    return key.view(np.int64)


def shingle_sets(block: Block, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingles of each row of a block; fewer words than ``size`` make one shingle."""
    hashed, rows, _ = words(block)
    bounds = np.searchsorted(rows, np.arange(block.last - block.first + 1))
    joined = np.zeros(max(len(hashed) - size + 1, 0), np.uint64)
    for k in range(size):
        joined = mix(joined + hashed[k : k + len(joined)]) + _STEP
    for low, high in zip(bounds[:-1], bounds[1:]):
        if high - low >= size:
            yield np.unique(joined[low : high - size + 1])
        elif high > low:
            whole = np.array([high - low], np.uint64)
            for k in range(low, high):
                whole = mix(whole + hashed[k])
            yield whole
        else:
            yield np.zeros(0, np.uint64)


def _longs(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0] + [len(p) for p in parts]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64), pa.int64()))


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch, "text"):
            sizes, keys = [], []
            for shingles in shingle_sets(block):
                sizes.append(len(shingles))
                keys.append(band_keys(signature(shingles, BANDS * BAND_ROWS), BANDS, BAND_ROWS)
                            if len(shingles) else np.zeros(0, np.int64))
            part = batch.slice(block.first, block.last - block.first)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("node"), pa.array(sizes, pa.int64()), _longs(keys)],
                names=["doc_id", "node", "n_shingles", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch, "text"):
            part = batch.slice(block.first, block.last - block.first)
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), _longs(list(shingle_sets(block)))], names=["node", "shingles"]
            )


def _with_node(texts: DataFrame) -> DataFrame:
    """Rows with their node: 128 bits of the lowered words, equal for equal word sequences."""
    plain = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    spaced = F.trim(F.regexp_replace(plain, r"[\x20\x09-\x0D]+", " "))
    return texts.withColumn("node", F.unhex(F.md5(spaced)))


def _sets_of(wanted: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Full sets of nodes. One row stands for all copies of a node, so a text with many copies is read once."""
    one = settle(nodes.join(wanted, "node").select(F.col("node").alias("one_node"), "one_id"), "one-each")
    ids = one.select("one_id").distinct()
    near = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("one_id")), "left_semi")  # then nodes of these rows only
    same = (F.col("node") == F.col("one_node")) & F.col("doc_id").eqNullSafe(F.col("one_id"))
    texts = _with_node(near).join(one, same, "left_semi").dropDuplicates(["doc_id", "node"])
    return settle(texts.select("node", "text").mapInArrow(_sets, "node binary, shingles array<long>"), "shingle-sets")


def _both_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with their sets left and right; a is the side that many pairs share."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    return pairs.join(right, "b").join(left, "a")


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) with ``linked``: whether the full sets are similar enough."""
    shared = F.size(F.array_intersect("left", "right")).cast("long")
    either = F.size("left") + F.size("right") - shared
    return _both_sets(pairs, sets).select("a", "b", (100 * shared >= PERCENT * either).alias("linked"))


def _stars(nodes: DataFrame) -> DataFrame:
    """Distinct (a, b) such that any two members of a bucket are, or share, an ``a``.

    The pivot of a bucket is the member that meets most others over all its buckets, and the
    root of a node the most connected of the pivots it meets. A text that others were made from
    is the root of nearly all of them, so one star stands for the many buckets of such a
    family. Only a bucket whose members have different roots gets a star of its own.
    """
    entries = nodes.select("node", F.explode("bands").alias("band"))
    shared = entries.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    # small sides are written first: a join of plain tables can split a bucket with many members
    members = settle(entries.join(settle(shared, "shared-bands"), "band"), "buckets")
    degrees = settle(members.groupBy("node").agg(F.sum("n").alias("degree")), "degrees")
    ranked = members.join(degrees, "node")
    pivots = settle(ranked.groupBy("band").agg(F.max(F.struct("degree", "node")).alias("pivot")), "pivots")
    met = members.join(pivots, "band").select("band", "node", "pivot")
    roots = settle(met.groupBy("node").agg(F.max("pivot")["node"].alias("root")), "roots")
    rooted = met.join(roots, "node")
    mixed = rooted.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = settle(mixed.where("low <> high").select("band"), "mixed-bands")
    own = met.join(mixed, "band").select(F.col("pivot.node").alias("a"), F.col("node").alias("b"))
    pairs = roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionByName(own)
    return settle(pairs.where("a <> b").distinct(), "stars")


def _crossing(stars: DataFrame, sets: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs of one star, not in one group so far, that may be linked.

    At least one of such a pair is outside the pivot's group, so not linked to the pivot.

    ``d(x)`` is the difference of a member to its pivot: what it adds and what it lacks. Two sets are
    linked exactly if ``7 |d(x) ^ d(y)| <= |x| + |y|``, so linked ones share at least
    ``need = (|d(x)| + |d(y)| - (|x| + |y|) / 7) / 2`` elements of their differences. In any common
    order of the elements the first ``|d| - need + 1`` of both then have one in common. The order
    here is by how many members of the star have the element: what an edit of one member alone
    brings in comes first. A member that is not linked to the pivot has a large difference, which
    leaves the other at most about half of its own: copies with edits of their own do not meet,
    however many share the pivot.
    """
    of_a = groups.select(F.col("node").alias("a"), F.col("component").alias("group_a"))
    of_b = groups.select(F.col("node").alias("b"), F.col("component").alias("group_b"))
    stars = stars.join(of_b, "b", "left").join(of_a, "a", "left").select(
        "a", "b", F.coalesce("group_b", "b").alias("group"),
        (F.coalesce("group_a", "a") == F.coalesce("group_b", "b")).alias("inside"),
    )
    stars = settle(stars, "grouped-stars")
    open_ = stars.groupBy("a").agg(F.count("*").alias("n"), F.count_if(~F.col("inside")).alias("outside"))
    open_ = settle(open_.where("n > 1 and outside > 0").select("a"), "open-stars")
    rows = _both_sets(stars.join(open_, "a"), sets)
    added, lacked = F.array_except("right", "left"), F.array_except("left", "right")
    rows = rows.select(
        F.xxhash64("a").alias("star"), "b", F.xxhash64("group").alias("group"), "inside",
        F.size("right").alias("n"), F.size("left").alias("of"), F.concat(added, lacked).alias("difference"),
    )
    d, n = F.size("difference"), F.col("n")
    # the least need against any member outside, and of a member outside against any other
    index = d - F.ceil((7 * d + F.col("of") + 1 - n) / 14) + 1
    probe = F.when(F.col("inside"), 0).otherwise(F.least(d, F.floor(n / 3) + 1))
    rows = rows.withColumn("d", d).withColumn("index", index.cast("int")).withColumn("probe", probe.cast("int"))
    flat = settle(rows.where("index > 0 or probe > 0").select(
        "star", "b", "group", "n", "d", "index", "probe", F.explode("difference").alias("element")
    ), "differences")
    held = settle(flat.groupBy("star", "element").agg(F.count("*").alias("held")).where("held > 1"), "held")
    order = Window.partitionBy("star", "b").orderBy(F.coalesce("held", F.lit(1)), "element")
    flat = flat.join(held, ["star", "element"], "left").withColumn("at", F.row_number().over(order) - 1)
    # an element of one member only takes its place in the order but meets nothing
    flat = settle(flat.where("held is not null and at < greatest(index, probe)").drop("held"), "prefixes")
    x = flat.where("at < probe").select("star", "element", F.col("b").alias("x"), F.col("group").alias("xg"), F.col("n").alias("xn"),
                                        F.col("d").alias("xd"), F.col("at").alias("xat"))
    y = flat.where("at < index").select("star", "element", F.col("b").alias("y"), F.col("group").alias("yg"), F.col("n").alias("yn"),
                                        F.col("d").alias("yd"), F.col("at").alias("yat"))
    need = F.ceil((7 * (F.col("xd") + F.col("yd")) - F.col("xn") - F.col("yn")) / 14)
    meet = (
        (x["star"] == y["star"]) & (x["element"] == y["element"]) & (F.col("xg") != F.col("yg"))
        & (F.col("xat") <= F.col("xd") - need) & (F.col("yat") <= F.col("yd") - need)
    )
    return x.join(y, meet).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, node, n_shingles, component_id (smallest id reachable), first (the one node to keep)."""
    plain = id_and_text(docs, id_col, text_col)
    signed = settle(
        _with_node(plain).select("doc_id", "node", "text").mapInArrow(
            _sign, "doc_id long, node binary, n_shingles long, bands array<long>"
        ),
        "signatures",
    )
    # copies of one word sequence are one node from here on
    nodes = signed.where("n_shingles > 0").groupBy("node").agg(
        F.first("bands").alias("bands"), F.min("doc_id").alias("one_id")
    )
    nodes = settle(nodes, "nodes")
    stars = _stars(nodes)
    sets = _sets_of(stars.select(F.explode(F.array("a", "b")).alias("node")).distinct(), plain, nodes)
    stars = settle(_measured(stars, sets), "measured")
    links = stars.where("linked").select("a", "b")
    groups = connected(links)
    crossing = settle(_measured(_crossing(stars, sets, groups), sets), "crossing")
    groups = connected(links.unionByName(crossing.where("linked").select("a", "b")))

    rows = signed.select("doc_id", "node", "n_shingles")
    # a row without words stays alone, whatever else is empty
    worded = rows.where("n_shingles > 0").join(groups, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    names = worded.groupBy("component").agg(
        F.min("doc_id").alias("component_id"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node"))["node"].alias("head"),
    )
    linked = worded.join(settle(names, "names"), "component").select(
        "doc_id", "node", "n_shingles", "component_id",
        ((F.col("node") == F.col("head")) & F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("first"),
    )
    alone = rows.where("n_shingles = 0").select(
        "doc_id", "node", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first")
    )
    return linked.unionByName(alone)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id and whether the row is its group's smallest id."""
    found = similar_groups(docs, id_col, text_col)
    return found.select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The table with one row of each group: the smallest id; of repeated rows one.

    Rows without words have no group and all stay.
    """
    first = similar_groups(docs, id_col, text_col).where("first and n_shingles > 0")
    first = first.select(F.col("doc_id").alias("first_id"), F.col("node").alias("first_node")).distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    flat = whole.select("row", f"row.`{id_col}`", f"row.`{text_col}`")
    own = _with_node(id_and_text(flat, id_col, text_col, "row"))
    worded = own.where(r"text rlike '[^\\x20\\x09-\\x0D]'")
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("node") == F.col("first_node"))
    kept = worded.join(first, same, "left_semi").dropDuplicates(["doc_id", "node"])
    empty = own.where(r"not text rlike '[^\\x20\\x09-\\x0D]'")
    return kept.unionByName(empty).select("row.*")
