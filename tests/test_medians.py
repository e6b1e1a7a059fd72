"""Exact medians against a sort, one group holding most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from townhall.operators import medians


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    n = 4000
    g = rng.choice(["a", "b", "c", "d"], n, p=[0.7, 0.2, 0.09, 0.01])
    v = rng.integers(-(2**62), 2**62, n)
    v = np.where(g == "b", rng.integers(-5, 5, n), v)
    v = np.where(g == "c", rng.integers(0, 2**45, n), v)
    hot = rng.random(n) < 0.3
    v = np.where(hot & (g == "a"), 7, v)
    return pd.DataFrame({"g": g, "v": v, "w": rng.integers(0, 3, n)})


def middle(s):
    s = sorted(int(x) for x in s)
    n = len(s)
    return (float(s[(n - 1) // 2]) + float(s[n // 2])) / 2


def test_groups(spark, frame):
    df = spark.createDataFrame(frame).repartition(5)
    got = medians.exact_medians(df, {"mv": F.col("v"), "mw": F.col("w")}, ["g"]).collect()
    want = frame.groupby("g").agg(mv=("v", middle), mw=("w", middle))
    assert {r.g: (r.mv, r.mw) for r in got} == {g: tuple(r) for g, r in want.iterrows()}


@pytest.mark.parametrize("values", [[5], [1, 2], [3, None, 1, 9], [-4, -4, 2, 2], [None, None]])
def test_whole_table(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = medians.exact_medians(df, {"m": F.col("v")}).collect()
    known = [v for v in values if v is not None]
    assert [r.m for r in got] == [middle(known) if known else None]


def test_empty(spark):
    df = spark.createDataFrame([], "g string, v bigint")
    assert medians.exact_medians(df, {"m": F.col("v")}, ["g"]).count() == 0
    assert [r.m for r in medians.exact_medians(df, {"m": F.col("v")}).collect()] == [None]


def test_groups_are_kept_apart(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 8)], "g string, v bigint")
    got = medians.exact_medians(df, {"m": F.col("v")}, ["g"]).collect()
    assert {r.g: r.m for r in got} == {"a": 2.0, "b": 8.0}
