"""Merkle manifest of a table: a tree of hashes for each source, one over the sources, and a proof for each row.

A source's leaves ascend by id; every ``FAN`` consecutive nodes become one. The digits of a leaf's rank
in base ``FAN`` are its place in the tree, so a tree is built by grouping the digits away, one after the
other: each grouping nests the children as structs inside their parent. ``LEVELS`` digits make a block of at
most ``FAN ** LEVELS`` leaves, shuffled by (tree, block) once; the groupings inside need no further shuffle. The
roots of the blocks are the leaves of the next tier, and the roots of the trees those of the tree over the
sources. Proofs come out downwards: a block's nested structs are transformed and exploded level by level, each
child taking along its siblings. No join touches a document: what a block hands down meets the blocks below one
to one.

Ranks are counted within range partitions, whose offsets are sums over the list of (partition, tree) counts,
so a source that holds most of the rows is no task of its own.

Defined results: a null id comes first and is never tampered with; a null source is a source of its own, the
first; equal rows are leaves of their own, in any order, as they cannot be told apart; rows of equal id ascend by
their leaf; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window

from townhall.session import settle

FAN = 3
LEVELS = 6  # of a block: at most 729 leaves


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def field(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, colon and value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def ranked(nodes: DataFrame, *order: str) -> DataFrame:
    """Columns of ``nodes`` with ``rank`` (from 0) within its tree and ``size`` of the tree."""
    marked = nodes.withColumn("copy", F.monotonically_increasing_id())  # parts equal rows of a hot id
    keys = ["tree", *order, "copy"]
    dealt = marked.repartitionByRange(*keys).withColumn("part", F.spark_partition_id())
    dealt = settle(dealt, "dealt")
    counts = dealt.groupBy("tree", "part").agg(F.count("*").alias("held"))
    of_tree = Window.partitionBy("tree")
    counts = settle(counts.select(  # at most one row a partition, and one a tree
        "tree", "part", F.sum("held").over(of_tree).alias("size"),
        (F.sum("held").over(of_tree.orderBy("part")) - F.col("held")).alias("before"),
    ), "offsets")
    inside = Window.partitionBy("tree", "part").orderBy(*order, "copy")
    numbered = dealt.withColumn("nth", F.row_number().over(inside))
    return numbered.join(counts, ["tree", "part"]).withColumn(
        "rank", F.col("before") + F.col("nth") - 1).drop("part", "before", "nth", "copy")


def _depth(size: Column) -> Column:
    """Levels until one node is left."""
    steps = F.array(*[F.lit(FAN**k) for k in range(40)])
    return F.size(F.filter(steps, lambda s: s < size))


def _rolled(nodes: DataFrame, tier: int) -> DataFrame:
    """Nodes (tree, depth, rank, node: struct with hash) -> one row (tree, depth, block, node) a block."""
    digits = [f"d{k}" for k in range(LEVELS)]
    span = FAN**LEVELS
    rows = nodes.select(
        "tree", "depth", F.floor(F.col("rank") / span).alias("block"), "node",
        *[F.floor(F.pmod("rank", F.lit(span)) / FAN**k % FAN).cast("tinyint").alias(d) for k, d in enumerate(digits)],
    ).repartition("tree", "block")
    for k, digit in enumerate(digits):
        rows = rows.groupBy("tree", "block", "depth", *digits[k + 1 :]).agg(
            F.sort_array(F.collect_list(F.struct(digit, "node.hash", "node"))).alias("kids"))
        hashes = F.transform("kids", lambda x: x["hash"])
        # above its own root a tree is handed up as it is
        done = F.col("depth") <= tier * LEVELS + k
        up = F.when(done, hashes[0]).otherwise(digest(F.array_join(hashes, "")))
        rows = rows.select(
            "tree", "block", "depth", *digits[k + 1 :],
            F.struct(up.alias("hash"), F.transform("kids", lambda x: x["node"]).alias("kids")).alias("node"))
    return rows


def _handed_down(blocks: DataFrame, tier: int) -> DataFrame:
    """Blocks with ``path`` and other columns of their tops -> (tree, rank, node, path, ...) of their leaves.

    A path lists the siblings from the lowest level up, as the hashes left and right of the node.
    """
    rows = blocks.withColumn("rank", F.col("block"))
    rest = [c for c in rows.columns if c not in ("node", "rank", "path", "block")]
    for k in reversed(range(LEVELS)):
        own = F.col("depth") > tier * LEVELS + k

        def beside(kids: Column) -> Column:
            return F.transform(kids, lambda kid, i: F.struct(
                kid.alias("node"), i.alias("digit"),
                F.array_join(F.transform(F.slice(kids, F.lit(1), i), lambda x: x["hash"]), "").alias("left"),
                F.array_join(F.transform(F.slice(kids, i + 2, F.lit(FAN)), lambda x: x["hash"]), "").alias("right")))

        rows = rows.select(*rest, "rank", "path", F.explode(beside(F.col("node.kids"))).alias("one"))
        step = F.array(F.struct(F.col("one.left").alias("left"), F.col("one.right").alias("right")))
        rows = rows.select(
            *rest, (F.col("rank") * FAN + F.col("one.digit")).alias("rank"), F.col("one.node").alias("node"),
            F.when(own, F.concat(step, F.col("path"))).otherwise(F.col("path")).alias("path"))
    return rows


def paths(nodes: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """Of nodes (tree, rank, size, node): the node with ``path`` to its tree's root, and ``top``, that root's hash.

    ``above`` hands on what it holds for each tree: its ``path`` is appended, other columns are kept. It is a
    function of the roots (tree, hash).
    """
    nodes = nodes.withColumn("depth", _depth(F.col("size"))).drop("size")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    tiers = []
    for tier in range(max(1, -(-deepest // LEVELS))):
        tiers.append(settle(_rolled(nodes, tier), f"blocks-{tier}"))
        nodes = tiers[-1].select(
            "tree", "depth", F.col("block").alias("rank"), F.struct(F.col("node.hash").alias("hash")).alias("node"))
    roots = nodes.select("tree", F.col("node.hash").alias("top"))
    held = above(roots) if above else roots.withColumn("path", F.array().cast("array<struct<left:string,right:string>>"))
    held = held.withColumn("block", F.lit(0).cast("long"))  # each tree is one block of the last tier
    for tier in reversed(range(len(tiers))):
        blocks = tiers[tier].join(held, ["tree", "block"])
        held = _handed_down(blocks, tier).withColumnRenamed("rank", "block")
        if tier:
            held = held.drop("node", "depth")
    return held.withColumnRenamed("block", "rank").drop("depth")


def manifest(docs: DataFrame, id_col: str = "doc_id", tree_col: str = "source", fields: tuple[str, ...] = (
        "doc_id", "source", "lang", "n_chars", "text"), text_col: str = "text") -> DataFrame:
    """Per row: id, leaf, tampered leaf (null where equal), subroot, root and path of siblings up to the root."""
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    values = {c: F.col(f"`{c}`") for c in fields}
    touched = F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 2 == 0, F.lit(False)) & text.contains("\n")
    other = {**values, text_col: F.replace(text.cast("string"), F.lit("\n"), F.lit(""))}
    # 's' before the name keeps the order and leaves '' to rows without a source
    tree = F.coalesce(F.concat(F.lit("s"), F.col(f"`{tree_col}`").cast("string")), F.lit(""))
    leaves = settle(docs.select(
        tree.alias("tree"), id_.cast("long").alias("id"), leaf_of(*values.values()).alias("leaf"),
        F.when(touched, leaf_of(*other.values())).alias("tampered")), "leaves")
    nodes = ranked(leaves, "id", "leaf").select(
        "tree", "rank", "size", F.struct(F.col("leaf").alias("hash"), "id", "tampered").alias("node"))

    def over_sources(roots: DataFrame) -> DataFrame:
        one = ranked(settle(roots.select(
            F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("top").alias("subroot")), "roots"), "name")
        top = paths(one.select(
            "tree", "rank", "size", F.struct(F.col("subroot").alias("hash"), "name").alias("node")))
        return settle(top.select(
            F.col("node.name").alias("tree"), F.col("node.hash").alias("subroot"), F.col("top").alias("root"), "path"), "subroots")

    found = paths(nodes, over_sources)
    return found.select(
        F.col("node.id").alias("doc_id"), F.col("node.hash").alias("leaf"), F.col("node.tampered").alias("tampered"),
        "subroot", "root", "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda held, x: digest(F.concat(x["left"], held, x["right"])))


def proofs(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root of the tampered leaf (if any), verified."""
    held = manifest(docs).withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    siblings = F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), "")
    return held.select(
        "doc_id", "leaf", "subroot", "root", digest(siblings).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
