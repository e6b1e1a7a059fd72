"""Windowed counts that keep what comes too late, instead of dropping it without a trace.

A row is late when its window had ended by the watermark of its batch: the largest event time of earlier batches, in
whole milliseconds, less the delay. A windowed aggregate of a stream drops rows by the same rule, only that it takes
the watermark of the batch before its own; where each delivery is a run of its own, both tell the same rows apart. The
late ones go to a table of their own, from which they can be added or looked at.

Every batch writes its own folders from what earlier ones wrote, so a batch repeated after a failure gives the same
result. The counts so far are as long as the windows and groups; the last two versions are kept, older ones go, so the
number of folders does not grow with that of the batches, but for the late rows, of which a batch without any
writes no file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from townhall.streaming.jobs import Place, forget, start

_KEPT_VERSIONS = 2


@dataclass(frozen=True)
class Split:
    """``counts``: (window_start, by, n). ``late``: rows as they came, with the batch that brought them."""

    counts: DataFrame
    late: DataFrame


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    whole = StructType([*schema.fields, StructField("batch", LongType())])
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/batch=-1")
    return spark.read.schema(whole).option("basePath", path).parquet(path)


def _last(spark: SparkSession, path: str, schema: StructType, before: int) -> DataFrame:
    """The latest version written before a batch."""
    versions = _read(spark, path, schema).where(F.col("batch") < before)
    last = versions.agg(F.max("batch")).first()[0]
    return versions.where(F.col("batch") == F.lit(-1 if last is None else last)).drop("batch")


def run_windows(
    stream: DataFrame, event_time: str, by: str, at: Place, window: str = "1 day", delay: str = "1 hour",
) -> Split:
    """Rows per tumbling window and group, as far as they came in time, and the late rows.

    A row without an event time is in no window, and kept out of both.
    """
    spark = stream.sparkSession
    counts_schema = StructType([
        StructField("window_start", TimestampType()), stream.schema[by], StructField("n", LongType())])
    mark_schema = StructType([StructField("seen", TimestampType())])
    counts_at, late_at, mark_at = (f"{at.out}/{name}" for name in ("counts", "late", "mark"))

    def write(batch: DataFrame, batch_id: int) -> None:
        mark = _last(spark, mark_at, mark_schema, batch_id).agg(
            F.date_trunc("millisecond", F.max("seen")) - F.expr(f"INTERVAL {delay}")).scalar()
        placed = batch.where(F.col(event_time).isNotNull()).withColumn("_w", F.window(event_time, window))
        placed = placed.persist()
        try:
            is_late: Column = F.coalesce(F.col("_w.end") <= mark, F.lit(False))
            placed.where(is_late).drop("_w").write.mode("overwrite").parquet(f"{late_at}/batch={batch_id}")
            fresh = placed.where(~is_late).groupBy(F.col("_w.start").alias("window_start"), by).agg(F.count(F.lit(1)).alias("n"))
            total = fresh.unionByName(_last(spark, counts_at, counts_schema, batch_id)).groupBy("window_start", by).agg(
                F.sum("n").alias("n"))
            total.write.mode("overwrite").parquet(f"{counts_at}/batch={batch_id}")
            seen = placed.agg(F.max(event_time).alias("seen")).unionByName(_last(spark, mark_at, mark_schema, batch_id))
            seen.agg(F.max("seen").alias("seen")).write.mode("overwrite").parquet(f"{mark_at}/batch={batch_id}")
        finally:
            placed.unpersist()
        for path in (counts_at, mark_at):
            forget(spark, path, batch_id - _KEPT_VERSIONS + 1)

    start(stream.writeStream.foreachBatch(write), at).awaitTermination()
    return Split(
        _last(spark, counts_at, counts_schema, 2**62),
        _read(spark, late_at, StructType(stream.schema.fields)).where(F.col("batch") >= 0))
