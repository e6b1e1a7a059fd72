"""Settings, the shared folder and written intermediates."""

import os

import pytest
from pyspark.sql import functions as F

from townhall.session import scratch_path, settle, shared_root


def test_shared_folder(spark):
    root = shared_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(root)


class _Plain:
    """A session in which the shared folder is not named."""

    def __init__(self, spark, master="local[2]"):
        self.conf, self.sparkContext = self, self
        self.master, self.applicationId = master, "app-without-a-folder"

    def get(self, key, default=None):
        return default


def test_without_the_setting(spark):
    root = shared_root(_Plain(spark))
    assert os.path.isdir(root) and shared_root(_Plain(spark)) == root
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(_Plain(spark, "spark://host:7077"))


def test_settled_table_no_longer_depends_on_its_source(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k")).groupBy("k").count()
    out = settle(df)
    assert out.schema.names == ["k", "count"] and out.count() == 7
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in text and "FileScan parquet" in text
