"""Connected components of a link table: union-find inside tasks, then shuffled star steps.

Every task first joins the links it holds with a union-find and passes on one link per node.
What remains is contracted by alternating star steps until no link changes; each step is
written to the shared folder. Links are never gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from townhall.session import settle


def _join_locally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:  # a batch at a time bounds the memory
        parent: dict[bytes, bytes] = {}

        def root(x: bytes) -> bytes:
            top = x
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        for a, b in zip(batch["a"].map(bytes), batch["b"].map(bytes)):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
        pairs = [(x, root(x)) for x in list(parent)]
        yield pd.DataFrame([p for p in pairs if p[0] != p[1]], columns=["a", "b"])


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b) with a > b.

    Large: each node's larger neighbours go to its least neighbour. Small: each node's
    smaller neighbours, and itself, go to the least of them.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def connected(links: DataFrame) -> DataFrame:
    """From links (a, b) of binary names: (node, component), the component being its least node.

    Nodes without a link do not appear. An empty table gives an empty result.
    """
    edges = settle(
        links.select("a", "b").mapInPandas(_join_locally, "a binary, b binary").distinct(), "edges"
    )
    mark = _mark(edges)
    while mark[0]:
        edges = settle(_star(_star(edges, large=True), large=False), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node")).distinct()
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return settle(found.unionByName(roots.select("node", F.col("node").alias("component"))), "components")
