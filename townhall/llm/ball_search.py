"""Exact ranked search: a sparse ball tree over document vectors, searched best-first by inner product.

A term's part of a document's score is an integer: the score of a query is an inner product of the query's
weights with the document's vector of such parts. Vectors hold the terms of a block of queries only, as no other
counts. Coordinates are scaled by the weights, so a query is a vector of ones over its terms.

Tasks build a ball tree (centroid, radius, halves split along the line between two far vectors) for every bounded shard
of their documents; no vector is shuffled. A query enters a tree at its root and goes on with the ball of the largest
bound. With S the query's terms, c a ball's centroid and r the largest distance of a vector from it, that is the
lesser of ``q.c + |q| r`` and the same bound taken in the query's own subspace, one axis at a time: ``sum over S of
c_t + r_t``, r_t the largest distance from the centroid upwards along t. Sparse vectors are nearly at right angles, so
the first alone rules out next to nothing. Bounds are floating-point numbers, so they are raised by more than their
rounding error; a ball is passed over only if its raised bound is below the tenth score found so far, so equal scores
are found too. Leaves are scored in 64-bit integers. The tenth scores are kept from shard to shard in a task, and the
best ten of all tasks are ranked in the end.

Queries are taken in blocks of at most ``BLOCK_TERMS`` terms (a longer query is a block of its own), each of
which runs over all documents. What a block sends to the tasks is bounded by that, whatever the table holds.
Terms are compared by 64-bit hashes of their bytes.

Defined results: a null text has no terms and is never found; queries without terms find nothing; every row
of the queries is ranked, repeated ones too; equal scores ascend by id, a null id first; without documents
the result is empty.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from townhall.llm.byte_arrays import Block, WindowHashes, blocks
from townhall.llm.frames import id_and_text
from townhall.session import settle

TOP = 10
BLOCK_TERMS = 8192
SHARD_CELLS = 1 << 22  # of a shard's dense matrix
MOST_ROWS, LEAF = 1024, 16
_SLACK = 1e-6  # of a bound; what is rounded to float32 errs by some 2^-24 of itself, sums are float64

_TERM = np.zeros(256, np.uint8)
for _c in [*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]:
    _TERM[_c] = _c + 32 if 65 <= _c < 91 else _c


def terms(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every term of a block of texts."""
    n = len(block.starts) - 1
    text = np.zeros(len(block.data) + n + 1, np.uint8)  # a gap before every row
    held = np.ones(len(text), bool)
    held[block.starts[:-1] + np.arange(n)] = False
    held[-1] = False
    text[held] = _TERM[block.data]
    gap = text == 0
    starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
    ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
    rows = np.searchsorted(block.starts[:-1] + np.arange(n), starts, "right") - 1
    return WindowHashes(text).at(starts, ends - starts), rows


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch, "text"):
            hashes, rows = terms(block)
            cuts = np.searchsorted(rows, np.arange(block.last - block.first + 1))
            lists = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(block.first, len(lists)), pa.array(lists, pa.list_(pa.int64()))],
                names=["item_id", "terms"])


@dataclass
class Queries:
    """Distinct terms of a block as sorted hashes, and each query's places among them."""

    ids: list[int | None]
    vocabulary: np.ndarray
    places: list[np.ndarray]


def query_blocks(queries: DataFrame, id_col: str, text_col: str) -> Iterator[Queries]:
    """Queries in blocks; the driver holds one at a time."""
    rows = id_and_text(queries, id_col, text_col).mapInArrow(_query_terms, "item_id long, terms array<long>")
    ids, lists, size = [], [], 0

    def made() -> Queries:
        words = np.unique(np.concatenate(lists))
        return Queries(list(ids), words, [np.searchsorted(words, t) for t in lists])

    for row in settle(rows, "queries").toLocalIterator():
        if not row["terms"]:
            continue
        if lists and size + len(row["terms"]) > BLOCK_TERMS:
            yield made()
            ids, lists, size = [], [], 0
        ids.append(row["item_id"])
        lists.append(np.array(row["terms"], np.int64).view(np.uint64))
        size += len(row["terms"])
    if lists:
        yield made()


def _vectors(vocabulary: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of terms of each text, and its counts of the vocabulary's."""
    for batch in batches:
        for block in blocks(batch, "text"):
            n = block.last - block.first
            hashes, rows = terms(block)
            total = np.bincount(rows, minlength=n)
            at = np.searchsorted(vocabulary, hashes)
            known = vocabulary[np.minimum(at, len(vocabulary) - 1)] == hashes
            pairs, counts = np.unique(rows[known] * len(vocabulary) + at[known], return_counts=True)
            cuts = np.searchsorted(pairs, np.arange(n + 1) * len(vocabulary))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(block.first, n), pa.array(total, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(pairs % len(vocabulary), pa.int32())),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(counts, pa.int32()))],
                names=["doc_id", "n", "places", "counts"])


def weights(n_docs: int, holders: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(h) + 1))) for h in holders], np.int64)


def parts(counts: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A term's part of the score before its weight, of documents with ``length`` terms."""
    m = 10 + (90 * length * n_docs) // n_terms
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


@dataclass
class Tree:
    """Nodes in heap order: ``order[first[i]:last[i]]`` are the rows of node i; children of i are 2i+1 and 2i+2."""

    order: np.ndarray
    first: np.ndarray
    last: np.ndarray
    centroid: np.ndarray
    radius: np.ndarray
    reach: np.ndarray  # centroid plus radius along each axis


def ball_tree(x: np.ndarray, leaf: int = LEAF) -> Tree:
    """Of the rows of ``x`` (float32); halves have equal sizes, so the tree is whole."""
    n = len(x)
    depth = max(0, math.ceil(math.log2(max(n, 1) / leaf)))
    nodes = 2 ** (depth + 1) - 1
    order = np.arange(n)
    first, last = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    centroid, radius = np.zeros((nodes, x.shape[1]), np.float32), np.zeros(nodes)
    reach = np.zeros_like(centroid)
    last[0] = n
    for i in range(nodes):
        a, b = first[i], last[i]
        if a == b:
            continue
        rows = x[order[a:b]]
        centroid[i] = rows.mean(axis=0, dtype=np.float64)
        reach[i] = rows.max(axis=0)  # without rounding
        away = rows - centroid[i]
        far = np.einsum("ij,ij->i", away, away, dtype=np.float64)
        # the difference to the rounded centroid is itself rounded, by at most 2^-24 of each cell
        radius[i] = math.sqrt(far.max()) * (1 + _SLACK)
        if 2 * i + 2 >= nodes:
            continue
        one = away[far.argmax()]
        gap = away - one
        other = away[np.einsum("ij,ij->i", gap, gap).argmax()]
        by = np.argsort(away @ (other - one), kind="stable")
        order[a:b] = order[a:b][by]
        middle = (a + b) // 2
        first[2 * i + 1], last[2 * i + 1] = a, middle
        first[2 * i + 2], last[2 * i + 2] = middle, b
    return Tree(order, first, last, centroid, radius, reach)


def bounds(tree: Tree, places: np.ndarray) -> np.ndarray:
    """For each node no less than any inner product of its rows with ones at ``places``."""
    toward = tree.centroid[:, places].sum(axis=1, dtype=np.float64)
    ball = toward + math.sqrt(len(places)) * tree.radius
    along = tree.reach[:, places].sum(axis=1, dtype=np.float64)
    return np.minimum(ball, along) * (1 + _SLACK) + 1.0


def search(tree: Tree, bound: np.ndarray, best: list[int], top: int = TOP) -> Iterator[np.ndarray]:
    """Leaves of a tree, best first, as rows; ``best`` is a heap of the highest scores so far, grown by the caller."""
    heap = [(-bound[0], 0)] if len(tree.order) else []
    while heap:
        most, i = heapq.heappop(heap)
        if len(best) >= top and -most < best[0]:
            return
        if 2 * i + 2 >= len(bound):
            if tree.first[i] < tree.last[i]:
                yield tree.order[tree.first[i] : tree.last[i]]
            continue
        for child in (2 * i + 1, 2 * i + 2):
            if tree.first[child] < tree.last[child]:
                heapq.heappush(heap, (-bound[child], child))


def _search_shards(queries: Queries, weight: np.ndarray, n_docs: int, n_terms: int,
                   batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best of a task's documents for each query, shard after shard."""
    width = len(queries.vocabulary)
    most = int(min(MOST_ROWS, max(LEAF, SHARD_CELLS // width)))
    found: list[list[tuple[int, int | None]]] = [[] for _ in queries.ids]
    best: list[list[int]] = [[] for _ in queries.ids]
    held: list[pa.RecordBatch] = []

    def shard(batch: pa.Table) -> None:
        ids = batch["doc_id"].to_pylist()
        lengths = batch["n"].to_numpy()
        sizes = np.array([len(x) for x in batch["places"]], np.int64)
        places = batch["places"].combine_chunks().flatten().to_numpy().astype(np.int64)
        counts = batch["counts"].combine_chunks().flatten().to_numpy().astype(np.int64)
        rows = np.repeat(np.arange(len(ids)), sizes)
        values = np.zeros((len(ids), width), np.int32)  # a part is below 10^6
        values[rows, places] = parts(counts, lengths[rows], n_docs, n_terms)
        tree = ball_tree(values.astype(np.float32) * weight.astype(np.float32))
        for q, own in enumerate(queries.places):
            for leaf in search(tree, bounds(tree, own), best[q]):
                scores = values[np.ix_(leaf, own)].astype(np.int64) @ weight[own]
                for row in np.flatnonzero(scores > 0 if len(best[q]) < TOP else scores >= max(1, best[q][0])).tolist():
                    score = int(scores[row])
                    found[q].append((score, ids[leaf[row]]))
                    if len(best[q]) < TOP:
                        heapq.heappush(best[q], score)
                    elif score > best[q][0]:
                        heapq.heapreplace(best[q], score)
            if len(found[q]) > 8 * TOP:
                found[q] = _best(found[q])

    for batch in batches:
        at = 0
        while at < len(batch):
            room = most - sum(len(b) for b in held)
            held.append(batch.slice(at, room))
            at += len(held[-1])
            if sum(len(b) for b in held) >= most:
                shard(pa.Table.from_batches(held))
                held = []
    if held:
        shard(pa.Table.from_batches(held))
    out = [(q, d, s) for q, pairs in enumerate(found) for s, d in _best(pairs)]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int64()),
         pa.array([r[2] for r in out], pa.int64())], names=["query", "doc_id", "score"])


def _best(pairs: list[tuple[int, int | None]]) -> list[tuple[int, int | None]]:
    return heapq.nsmallest(TOP, pairs, key=lambda p: (-p[0], p[1] is not None, p[1] or 0))


def _answers(docs: DataFrame, queries: Queries) -> DataFrame | None:
    vectors = settle(docs.mapInArrow(
        partial(_vectors, queries.vocabulary), "doc_id long, n long, places array<int>, counts array<int>"), "vectors")
    total = vectors.where("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    if not total["docs"]:
        return None
    holders = np.zeros(len(queries.vocabulary), np.int64)
    counted = vectors.select(F.explode("places").alias("place")).groupBy("place").agg(F.count("*").alias("held"))
    for row in counted.collect():  # at most a row for each term of the block
        holders[row["place"]] = row["held"]
    weight = weights(total["docs"], holders)
    found = vectors.where(F.size("places") > 0).mapInArrow(
        partial(_search_shards, queries, weight, total["docs"], total["terms"]), "query int, doc_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
        .select(F.element_at(F.lit(queries.ids).cast("array<long>"), F.col("query") + 1).alias("item_id"), "rank", "doc_id", "score")
    )


def ranked_search(
    docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    query_id: str = "item_id", query_text: str = "text",
) -> DataFrame:
    """The ten documents of highest score above 0 for each query: item_id, rank, doc_id, score."""
    plain = id_and_text(docs, id_col, text_col)
    out = docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in query_blocks(queries, query_id, query_text):
        answers = _answers(plain, block)
        if answers is not None:
            out = out.unionByName(answers)
    return out
