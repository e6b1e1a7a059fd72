"""Posts kept in buckets of their key, so that loads, dedupes and joins leave what is stored where it is.

A store is a folder with generations, each a bucketed Parquet table. A load shuffles its batch only, cut to one row per
key, to the buckets, and adds the rows whose key is not there. Adding is safe to repeat: a load that was
broken off has stored some of its rows, and repeated it adds the others. Every load adds at most one file per bucket;
``compact`` writes a generation with one file per bucket, bucket by bucket, without a shuffle.

A generation counts once the job that wrote it has ended. The one before it stays until the next ``compact``, for
readers that planned on it. One writer at a time. Rows without a key are not stored.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.types import StructType

from townhall.operators.identity import keep_first
from townhall.sources import folders

_KEPT_BUCKETS = "spark.sql.sources.bucketing.autoBucketedScan.enabled"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@contextmanager
def _scans_by_bucket(spark: SparkSession):
    """One task per bucket, also where no join or grouping asks for it."""
    before = spark.conf.get(_KEPT_BUCKETS)
    spark.conf.set(_KEPT_BUCKETS, "false")
    try:
        yield
    finally:
        spark.conf.set(_KEPT_BUCKETS, before)


@dataclass(frozen=True)
class PostStore:
    spark: SparkSession
    path: str
    schema: StructType
    key: str
    buckets: int

    @classmethod
    def open(cls, spark: SparkSession, path: str, schema: StructType, key: str = "id", buckets: int = 256) -> PostStore:
        """The store at a path, made if there is none. Choose as many buckets as keep one bucket small."""
        layout = f"{path}/layout"
        if not folders.complete(spark, layout):
            spark.createDataFrame([(key, buckets)], "key string, buckets int").coalesce(1).write.mode("overwrite").json(layout)
        made = spark.read.schema("key string, buckets int").json(layout).first()
        if (made["key"], made["buckets"]) != (key, buckets):
            raise ValueError(f"the store at {path} has {made['buckets']} buckets of {made['key']}")
        return cls(spark, path, schema, key, buckets)

    def generation(self) -> int:
        """The latest whole generation; 0 before the first load."""
        found = [n for n in folders.names(self.spark, self.path, "gen=") if folders.complete(self.spark, f"{self.path}/{n}")]
        return max((int(n.removeprefix("gen=")) for n in found), default=0)

    def _name(self, generation: int) -> str:
        return f"store_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}_{generation}"

    def _table(self, generation: int) -> str:
        """A generation as a table of this session's catalog, which tells Spark of its buckets."""
        name = self._name(generation)
        key, place = _quoted(self.key), f"{self.path}/gen={generation}".replace("'", "\\'")
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in self.schema)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS "
            f"LOCATION '{place}'")
        return name

    def _writer(self, rows: DataFrame, generation: int) -> DataFrameWriter:
        return (
            rows.write.format("parquet").bucketBy(self.buckets, self.key).sortBy(self.key)
            .option("path", f"{self.path}/gen={generation}")
        )

    def posts(self) -> DataFrame:
        """All stored rows. Grouping and joining by the key need no shuffle of them."""
        name = self._table(self.generation())
        self.spark.catalog.refreshTable(name)  # another session may have loaded meanwhile
        return self.spark.table(name).select(*[_quoted(f.name) for f in self.schema])

    def fresh(self, batch: DataFrame, order: list) -> DataFrame:
        """First copies of the keys of a batch that are not stored; of the store only the keys are read."""
        first = keep_first(batch.where(batch[_quoted(self.key)].isNotNull()), [_quoted(self.key)], order)
        known = self.posts().select(_quoted(self.key)).hint("merge")  # a broadcast would grow with the store
        return first.join(known, self.key, "left_anti").select(*[_quoted(f.name) for f in self.schema])

    def load(self, batch: DataFrame, order: list) -> None:
        """Adds what ``fresh`` gives; its rows already lie by bucket, so there is one file for each."""
        at = self.generation()
        name = self._table(at)
        self._writer(self.fresh(batch, order), at).mode("append").saveAsTable(name)

    def compact(self) -> None:
        """Writes the next generation and removes those before the current one."""
        at = self.generation()
        rows = self.posts()
        broken_off = f"{self.path}/gen={at + 1}"
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(at + 1)}")
        folders.remove(self.spark, broken_off)
        with _scans_by_bucket(self.spark):
            self._writer(rows, at + 1).mode("overwrite").saveAsTable(self._name(at + 1))
        for name in folders.names(self.spark, self.path, "gen="):
            if int(name.removeprefix("gen=")) < at:
                folders.remove(self.spark, f"{self.path}/{name}")
