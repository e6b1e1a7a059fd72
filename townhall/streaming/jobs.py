"""Structured Streaming jobs: ingest, dedupe, windowed counts, running figures.

Hot keys: aggregates add up inside every task before the shuffle; the dedupe
works in two steps, the first of which spreads copies of one key over many
tasks. Every job runs at a ``Place``; run there again, it goes on where it stopped.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from townhall.operators.identity import keep_first, new_rows
from townhall.schema import CAPTURE
from townhall.session import scratch_path
from townhall.sources import folders
from townhall.sources.store import PostStore

_SPREAD = 32


# -- sources -----------------------------------------------------------------


def capture_stream(spark: SparkSession, path: str, array: bool = False, files_per_batch: int = 1000) -> DataFrame:
    """Capture files as they land, payloads as VARIANT."""
    return (
        spark.readStream.schema(CAPTURE)
        .option("multiLine", array)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("landed"),
                "url", "data")
    )


def table_stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet files as they land; the path may name one file, a folder or a pattern."""
    if not any(c in path for c in "*?[{"):
        path = path[:-1] + f"[{path[-1]}]"  # a pattern may match a single file, a plain path may not
    return spark.readStream.schema(schema).parquet(path)


# -- transformations ---------------------------------------------------------


def dedupe(stream: DataFrame, key: str, event_time: str, spread_by: Column, delay: str = "1 day") -> DataFrame:
    """One row per key as long as its copies arrive within ``delay`` of each other.

    ``spread_by`` is something that differs between copies (a row id, a position).
    Copies are first thinned out within ``_SPREAD`` salted groups per key, so the
    final step sees at most that many rows of any key per batch.
    """
    salted = stream.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(_SPREAD)))
    thinned = salted.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key, "_salt"]).drop("_salt")
    return thinned.dropDuplicatesWithinWatermark([key])


def first_copies(stream: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """The first copy of every key in ``order``, corrected when an earlier one arrives
    late (update mode). Copies are reduced in every task before the shuffle."""
    return stream.groupBy(key).agg(
        F.min(order).alias(order),
        *[F.min_by(c, order).alias(c) for c in columns],
    )


def window_counts(
    stream: DataFrame, event_time: str, by: str, window: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """Rows per tumbling window and group; rows later than ``delay`` are dropped."""
    return (
        stream.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, window).alias("w"), by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), by, "n")
    )


def month_counts(stream: DataFrame, event_time: str, by: str) -> DataFrame:
    """Rows per month and group, kept current in complete mode."""
    return stream.groupBy(F.date_trunc("month", event_time).alias("month_start"), by).agg(
        F.count(F.lit(1)).alias("n"))


def running_figures(
    stream: DataFrame, amount: str, member: str, answered: Column, by: str | None = None
) -> DataFrame:
    """Count, sum, mean and about the median of an amount, answered rows and about how many members.

    Kept current in complete mode. State is one row per group; the median and the distinct count
    are sketches, as exact ones would hold every value.
    """
    return stream.groupBy(*([by] if by else [])).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(amount).alias("total"),
        F.avg(amount).alias("mean"),
        F.percentile_approx(amount, 0.5, 10_000).alias("median_about"),
        F.count_if(answered).alias("answered"),
        F.approx_count_distinct(member, 0.02).alias("members_about"),
    )


# -- sinks -------------------------------------------------------------------


@dataclass(frozen=True)
class Place:
    """Where a job keeps its result and its progress, and how it is triggered.

    Running a job again at its place goes on where it stopped. ``trigger`` holds the arguments
    of ``DataStreamWriter.trigger``; the default takes what is there and ends.
    """

    out: str
    checkpoint: str
    trigger: dict = field(default_factory=lambda: {"availableNow": True})

    @classmethod
    def new(cls, spark: SparkSession, label: str) -> Place:
        """An unused place in the shared folder."""
        root = scratch_path(spark, label)
        return cls(f"{root}/out", f"{root}/progress")


def start(writer: DataStreamWriter, at: Place) -> StreamingQuery:
    return writer.option("checkpointLocation", at.checkpoint).trigger(**at.trigger).start()


def _versions(spark: SparkSession, schema: StructType, at: Place, *parts: str) -> DataFrame:
    """What all batches have written: a folder each, so a repeated batch replaces its own."""
    whole = StructType([*schema.fields, *(StructField(p, LongType()) for p in ("batch", *parts))])
    # an empty first folder, so that there is something to read before the first batch
    first = "/".join(["batch=-1", *(f"{p}=-1" for p in parts)])
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{at.out}/{first}")
    return spark.read.schema(whole).option("basePath", at.out).parquet(at.out)


def run_append(stream: DataFrame, at: Place) -> DataFrame:
    """Append results to files, and read them."""
    spark = stream.sparkSession
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", at.out)
    start(writer, at).awaitTermination()
    return spark.read.schema(stream.schema).parquet(at.out)


def forget(spark: SparkSession, path: str, before: int) -> None:
    """Deletes the folders of batches before one; a later one must hold what they held."""
    for name in folders.names(spark, path, "batch="):
        if -1 < int(name.removeprefix("batch=")) < before:
            folders.remove(spark, f"{path}/{name}")


def run_update(stream: DataFrame, keys: list[str], at: Place, compact: int = 32) -> DataFrame:
    """Update mode: a batch writes the keys it changed; the result is the latest version of each.

    Every ``compact`` batches one writes the latest version of all keys, and what lies before the last such batch
    goes. Its own predecessors stay until then, so it can be repeated; there are at most twice as many folders.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        whole = batch_id % compact == compact - 1
        if whole:
            earlier = _versions(spark, stream.schema, at).where(F.col("batch") < batch_id)
            both = batch.withColumn("batch", F.lit(batch_id).cast("long")).unionByName(earlier)
            batch = keep_first(both, keys, [F.desc("batch")]).select(*stream.columns)
        batch.write.mode("overwrite").parquet(f"{at.out}/batch={batch_id}")
        if whole:
            forget(spark, at.out, batch_id - compact)

    start(stream.writeStream.outputMode("update").foreachBatch(write), at).awaitTermination()
    versions = _versions(spark, stream.schema, at)
    return keep_first(versions, keys, [F.desc("batch")]).select(*stream.columns)


def _latest(versions: DataFrame, before: int | None = None) -> DataFrame:
    """The rows of the last batch that wrote any."""
    if before is not None:
        versions = versions.where(F.col("batch") < before)
    last = versions.agg(F.max("batch")).first()[0]
    return versions.where(F.col("batch") == F.lit(-1 if last is None else last)).drop("batch")


def _run_batches(stream: DataFrame, mode: str, at: Place, merge) -> DataFrame:
    """Run ``merge(batch, so_far)`` for every batch and read what the last one wrote.

    Batch n writes its own folder from what earlier ones wrote, so a batch repeated
    after a failure gives the same result.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        so_far = _latest(_versions(spark, stream.schema, at), batch_id)
        merge(batch, so_far).write.mode("overwrite").parquet(f"{at.out}/batch={batch_id}")

    start(stream.writeStream.outputMode(mode).foreachBatch(write), at).awaitTermination()
    return _latest(_versions(spark, stream.schema, at))


def run_complete(stream: DataFrame, at: Place) -> DataFrame:
    """Complete mode; every batch replaces the result."""
    return _run_batches(stream, "complete", at, lambda batch, so_far: batch)


def run_top(stream: DataFrame, k: int, by: str, tie: str, at: Place) -> DataFrame:
    """Running top-k: the best of each batch and of the list so far."""
    order = [F.desc(by), F.asc(tie)]

    def best(batch: DataFrame, so_far: DataFrame) -> DataFrame:
        return batch.orderBy(*order).limit(k).unionByName(so_far).orderBy(*order).limit(k)

    return _run_batches(stream, "append", at, best)


# Batches that only add rows are merged in tiers: a folder span=s/batch=b holds the rows of the s batches up to b.
# With a fan of 32 a row is written once, once more with 32 batches, once more with 1,024, and so on.


def tier_span(batch: int, fan: int) -> int:
    """Of how many batches up to this one its folder holds the rows."""
    span = 1
    while (batch + 1) % (span * fan) == 0:
        span *= fan
    return span


def tiers_in_use(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of folders (span, batch) those that no later or longer one holds the rows of."""
    kept, low = [], None
    for span, batch in sorted(found, key=lambda f: (f[1], f[0]), reverse=True):
        if low is None or batch < low:
            kept.append((span, batch))
            low = batch - span + 1
    return kept


def _tiers(spark: SparkSession, at: Place) -> list[tuple[int, int]]:
    """Folders (span, batch) that are written to their end."""
    found = []
    for span in folders.names(spark, at.out, "span="):
        for batch in folders.names(spark, f"{at.out}/{span}", "batch="):
            if folders.complete(spark, f"{at.out}/{span}/{batch}"):
                found.append((int(span.removeprefix("span=")), int(batch.removeprefix("batch="))))
    return found


def _tier_rows(spark: SparkSession, schema: StructType, at: Place, tiers: list[tuple[int, int]]) -> DataFrame:
    whole = StructType([*schema.fields, StructField("bucket", LongType())])
    if not tiers:
        return spark.createDataFrame([], whole)
    paths = [f"{at.out}/span={span}/batch={batch}" for span, batch in tiers]
    return spark.read.schema(whole).option("basePath", at.out).parquet(*paths).select(*whole.fieldNames())


def run_new_posts(stream: DataFrame, key: str, order: list, at: Place, buckets: int = 256, fan: int = 32) -> DataFrame:
    """First-wins loading: every batch adds the first copy of each key not seen before.

    Loaded rows lie in folders by a hash of their key. A batch reads the keys of the buckets
    it touches and no others, so choose as many buckets as keep one bucket small. Folders of batches are
    merged in tiers of ``fan``, so there are at most ``fan`` in use for each power of it, and as many again that
    wait until the next merge, as a merging batch may be repeated and a reader may still use them.
    """
    spark = stream.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets))

    def write(batch: DataFrame, batch_id: int) -> None:
        first = keep_first(batch, [key], order).withColumn("bucket", bucket).persist()
        try:
            touched = [r["bucket"] for r in first.select("bucket").distinct().collect()]  # at most ``buckets``
            written = _tiers(spark, at)
            earlier = tiers_in_use([t for t in written if t[1] < batch_id])  # earlier batches, so repeats agree
            loaded = _tier_rows(spark, stream.schema, at, earlier).where(F.col("bucket").isin(touched))
            rows, span = new_rows(first, loaded, key, spread=1), tier_span(batch_id, fan)
            if span > 1:
                merged = [t for t in earlier if t[1] > batch_id - span]
                rows = rows.unionByName(_tier_rows(spark, stream.schema, at, merged)).hint("rebalance", F.col("bucket"))
            rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{at.out}/span={span}/batch={batch_id}")
            if span > 1:
                old = [t for t in written if t[1] <= batch_id - fan]
                for gone in set(old) - set(tiers_in_use(old)):
                    folders.remove(spark, f"{at.out}/span={gone[0]}/batch={gone[1]}")
        finally:
            first.unpersist()

    start(stream.writeStream.foreachBatch(write), at).awaitTermination()
    return _tier_rows(spark, stream.schema, at, tiers_in_use(_tiers(spark, at))).select(*stream.columns)


def run_stored(stream: DataFrame, store: PostStore, order: list, at: Place, compact: int = 32) -> DataFrame:
    """First-wins loading into a bucketed store, of which no row is shuffled; every ``compact`` batches it is compacted.

    A repeated batch adds what its first attempt had not stored. ``at`` keeps the progress alone.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        store.load(batch, order)
        if batch_id % compact == compact - 1:
            store.compact()

    start(stream.writeStream.foreachBatch(write), at).awaitTermination()
    return store.posts()
