"""Document fingerprints from closed syncmers, as SQL expressions only.

A text is read as tokens: words, single characters of scripts written without spaces, and
single characters of runs too long to be words. A k-mer of tokens is an anchor when the least
of the hashes of its inner pairs lies at its first or last place. Whether it does depends on
the k-mer alone, so an edit moves no anchor outside the k tokens around it.

A text with tokens but no anchor has one: its least k-mer, or all its tokens where they are
fewer than k. A text without tokens is hashed as it stands; an empty one has no anchor.

Defined results: a null text is empty; two empty texts are alike (1.0), an empty and another
are not (0.0); rows with one id follow each other in the order of a hash of their texts, rows
without id come last; a single document is its own next one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from townhall.llm.expressions import let, up_to
from townhall.llm.frames import id_and_text

K = 8
INNER = 2

_UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
_LETTER = r"[\p{L}\p{M}\p{N}]"
TOKEN = rf"{_UNSPACED}|(?<!{_LETTER}){_LETTER}{{1,32}}(?!{_LETTER})|{_LETTER}"


def tokens(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(f"({TOKEN})"), F.lit(1)), lambda w: F.xxhash64(w))


def anchors(text: Column) -> Column:
    """Hash and token position of the anchors of a text, in text order."""
    window = K - INNER + 1

    def kmer(t: Column, i: Column) -> Column:
        return F.struct(F.xxhash64(*[F.get(t, i + j) for j in range(K)]).alias("hash"), i.alias("at"))

    def closed(inner: Column, i: Column) -> Column:
        edge = F.least(F.get(inner, i), F.get(inner, i + (window - 1)))
        return edge <= F.least(*[F.get(inner, i + j) for j in range(1, window - 1)])

    def chosen(t: Column) -> Column:
        inner = F.transform(up_to(F.size(t) - (INNER - 1)), lambda i: F.xxhash64(F.get(t, i), F.get(t, i + 1)))
        places = let(inner, lambda s: F.filter(up_to(F.size(t) - (K - 1)), lambda i: closed(s, i)))
        every = F.transform(up_to(F.size(t) - (K - 1)), lambda i: kmer(t, i))
        whole = F.array(F.struct(F.xxhash64(t).alias("hash"), F.lit(0).alias("at")))
        return (
            F.when(F.size(t) < K, whole)
            .otherwise(let(places, lambda p: F.when(
                F.size(p) > 0, F.transform(p, lambda i: kmer(t, i))
            ).otherwise(F.array(F.array_min(every)))))
        )

    bare = F.array(F.struct(F.xxhash64(text).alias("hash"), F.lit(0).alias("at")))
    none = F.array().cast("array<struct<hash: bigint, at: int>>")
    return let(tokens(text), lambda t: F.when(F.size(t) > 0, chosen(t)).when(text != "", bare).otherwise(none))


def written(found: Column) -> Column:
    """Anchors as text: hash@position, in text order."""
    return F.array_join(F.transform(found, lambda a: F.concat(F.hex(a["hash"]), F.lit("@"), a["at"])), " ")


def likeness(left: Column, right: Column) -> Column:
    """Share of the distinct anchors of two texts that both have."""
    a, b = left["hash"], right["hash"]
    return let(F.size(F.array_union(a, b)), lambda n: F.when(n == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(a, b)) / n
    ))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text and its anchors."""
    return id_and_text(docs, id_col, text_col).withColumn("anchors", anchors(F.col("text")))


def shared_places(left: DataFrame, right: DataFrame) -> DataFrame:
    """Positional matches of two sets of fingerprints: ids, positions and how far the text moved.

    Positions are paired by anchor; an anchor that a text holds more than once pairs by its
    order of occurrence, so a repeated anchor gives as many rows as the rarer side has of it.
    """

    def flat(df: DataFrame, side: str) -> DataFrame:
        rows = df.select(F.col("doc_id").alias(f"{side}_id"), F.explode("anchors").alias("a"))
        rows = rows.select(f"{side}_id", F.col("a.hash").alias("hash"), F.col("a.at").alias(f"{side}_at"))
        nth = Window.partitionBy(f"{side}_id", "hash").orderBy(f"{side}_at")
        return rows.withColumn("nth", F.row_number().over(nth))

    both = flat(left, "left").join(flat(right, "right"), ["hash", "nth"])
    return both.select("left_id", "left_at", "right_id", "right_at", (F.col("right_at") - F.col("left_at")).alias("moved"))


def _ranges(docs: DataFrame, parts: int) -> tuple[list[int], int | None]:
    """At most ``parts - 1`` ids that cut the table into ranges of about equal size, and the largest id."""
    steps = [k / parts for k in range(1, parts)] or [0.5]
    row = docs.agg(F.percentile_approx("doc_id", steps, 50 * parts), F.max("doc_id")).first()
    return sorted({c for c in row[0] or [] if c < row[1]}), row[1]


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, anchors, and text and anchors of the next document by descending id.

    Ranges of ids are dealt out by number; the first document of each is sent to the range
    above it as well, so the next one is always in the same task and texts move once.
    """
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts, largest = _ranges(docs, parts)
    edges = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    steps = [1 << b for b in reversed(range(max(len(cuts), 1).bit_length()))]
    place = F.aggregate(  # binary search: how many cuts lie below the id
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, s: F.when(F.get(edges, at + s - 1) < F.col("doc_id"), at + s).otherwise(at),
    )
    own = lambda at: F.struct(at.alias("range"), F.lit(0).alias("copy"))
    copy = lambda at: F.struct(at.alias("range"), F.lit(1).alias("copy"))
    placed = docs.select("doc_id", "text", F.coalesce(place, F.lit(0)).alias("place"))
    at = F.col("place")
    rooms = F.when(F.col("doc_id").eqNullSafe(F.lit(largest)), F.array(own(at), copy(F.lit(0)))).when(
        F.get(edges, at) == F.col("doc_id"), F.array(own(at), copy(at + 1))
    ).otherwise(F.array(own(at)))
    dealt = placed.select("doc_id", "text", F.explode(rooms).alias("room")).select("doc_id", "text", "room.*")
    dealt = dealt.repartition("range").withColumn("anchors", anchors(F.col("text")))
    order = Window.partitionBy("range").orderBy("copy", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    return dealt.select(
        "doc_id", "text", "anchors", "copy", F.lead("text").over(order).alias("next_text"),
        F.lead("anchors").over(order).alias("next_anchors"),
    ).where("copy = 0").drop("copy")


def edit_check(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the fingerprints of a text and its edited form, and how alike they and the next one are."""
    rows = with_next(id_and_text(docs, id_col, text_col))
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.left(F.col("text"), n - cut), F.left(F.col("next_text"), cut))
    rows = rows.withColumn("edited", F.when(cut > 0, edited).otherwise(F.col("text")))
    rows = rows.withColumn("edited_anchors", anchors(F.col("edited")))
    return rows.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("anchors")).alias("fingerprint"), written(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )
