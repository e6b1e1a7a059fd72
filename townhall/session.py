"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "townhall", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or reuse) a session; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """These settings for as long as the block runs, then those from before."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


_OWN: dict[str, str] = {}  # an application's own folder, where the setting is empty


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        _OWN[app] = tempfile.mkdtemp(prefix="townhall-")
        atexit.register(shutil.rmtree, _OWN[app], ignore_errors=True)  # our own folder, for this process only
    return _OWN[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/townhall/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str = "step") -> DataFrame:
    """Write an intermediate result to the shared folder and go on from the written table.

    The steps after it do not compute it again, a lost executor costs a re-read
    only, and its size is known to the optimizer.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
