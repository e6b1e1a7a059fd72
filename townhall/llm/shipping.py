"""Prepares a session for the operators: sends this package to the executors, as ``--py-files`` would,
and bounds the rows that a Python worker is given at once, as each of them may be a long text."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import townhall

_DONE: set[str] = set()


_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
MOST_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Sets the bound; sends the package once per application. The archive holds source files only."""
    if int(spark.conf.get(_ROWS)) > MOST_ROWS:
        spark.conf.set(_ROWS, str(MOST_ROWS))
    app = spark.sparkContext.applicationId
    if app in _DONE:
        return
    root = os.path.dirname(os.path.abspath(townhall.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="townhall-code-"), "townhall.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _DONE.add(app)
