"""First-wins state with corrections, and loads that count their stages."""

import datetime as dt
import glob
import json
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from townhall.operators import capture
from townhall.streaming import corrections, jobs, late

SCHEMA = "id long, row long, ts timestamp"
START = dt.datetime(2024, 3, 1)


def arrive(spark, path, at, rows, **how):
    """One more delivery, and everything passed on so far."""
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("append").parquet(path)
    stream = spark.readStream.schema(SCHEMA).parquet(path)
    return jobs.run_append(corrections.first_with_corrections(stream, "id", "row", "ts", F.col("row"), **how), at)


def test_late_copies_correct_what_was_passed_on(spark, tmp_path):
    """Three deliveries, each by a query that starts anew; a third of the rows have one id."""
    rng = random.Random(1)
    rows = [(0 if rng.random() < 0.34 else rng.randrange(1, 60), k, START + dt.timedelta(seconds=k)) for k in range(600)]
    rng.shuffle(rows)
    path, at = f"{tmp_path}/in", jobs.Place(f"{tmp_path}/out", f"{tmp_path}/progress")
    held, passed = {}, []
    for part in (rows[:250], rows[250:400], rows[400:]):
        low = {}
        for i, k, _ in part:
            low[i] = min(low.get(i, k), k)
        for i, k in low.items():
            if i not in held or k < held[i]:
                passed.append((i, k, i in held))
                held[i] = k
        out = arrive(spark, path, at, part)
        assert sorted((r.id, r.row, r.correction) for r in out.collect()) == sorted(passed)
    assert held == {r.id: r.first for r in spark.read.parquet(path).groupBy("id").agg(F.min("row").alias("first")).collect()}


def test_state_ends_after_the_delay(spark, tmp_path):
    path, at = f"{tmp_path}/in", jobs.Place(f"{tmp_path}/out", f"{tmp_path}/progress")
    how = {"delay_ms": 3_600_000, "late": "0 seconds"}
    arrive(spark, path, at, [(1, 50, START)], **how)
    arrive(spark, path, at, [(2, 60, START + dt.timedelta(hours=5))], **how)  # moves the watermark on
    arrive(spark, path, at, [(3, 70, START + dt.timedelta(hours=6))], **how)
    out = arrive(spark, path, at, [(1, 40, START + dt.timedelta(hours=7)), (3, 65, START + dt.timedelta(hours=6, minutes=30))], **how)
    assert sorted((r.id, r.row, r.correction) for r in out.collect()) == [
        (1, 40, False), (1, 50, False), (2, 60, False), (3, 65, True), (3, 70, False)]


def test_hot_keys_and_copies_without_a_time(spark, tmp_path, monkeypatch):
    """Keys count as hot from their second copy in a read; a missing key is a key, a missing time is never late."""
    monkeypatch.setattr(corrections, "_HOT", 1)
    path, at = f"{tmp_path}/in", jobs.Place(f"{tmp_path}/out", f"{tmp_path}/progress")
    one = [(k % 3 or None, 1000 - k, None if k % 5 == 0 else START) for k in range(60)] + [(7, 5, None), (8, None, START)]
    arrive(spark, path, at, one)
    out = arrive(spark, path, at, [(1, 3, START), (7, 4, START), (7, 9, None), (None, 2, None)])
    assert sorted((r.id or 0, r.row, r.correction) for r in out.collect()) == [
        (0, 2, True), (0, 943, False), (1, 3, True), (1, 942, False), (2, 941, False), (7, 4, True), (7, 5, False)]


def test_corrections_in_a_plain_session(tmp_path):
    """No settings of ours, and workers that do not find this package."""
    code = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from pyspark.sql import SparkSession, functions as F\n"
        "spark = SparkSession.builder.master('local[2]').config(map={'spark.ui.enabled': 'false',"
        " 'spark.sql.shuffle.partitions': '2', 'spark.checkpoint.dir': sys.argv[2]}).getOrCreate()\n"
        "rows = spark.range(12).select(F.col('id').alias('event_id'), (F.col('id') % 4).alias('user_id'),"
        " F.lit('view').alias('event_type'), F.timestamp_seconds(F.col('id') + 10**9).alias('ts'))\n"
        "rows.coalesce(1).write.parquet(sys.argv[2] + '/events.parquet')\n"
        "from townhall.plans.catalogue import CATALOGUE\n"
        "print(sorted(map(tuple, CATALOGUE['stream_corrections'](spark, sys.argv[2]).collect())))\n"
        "print(spark.conf.get('spark.sql.streaming.stateStore.providerClass'))\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"TZ": "America/New_York"}
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    said = subprocess.run(
        [sys.executable, "-c", code, repo, str(tmp_path)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert said.returncode == 0, said.stderr[-2000:]
    first, store = said.stdout.splitlines()[-2:]
    assert first == "[(0, 0, 'view', 2), (1, 1, 'view', 1), (2, 2, 'view', 0), (3, 3, 'view', 2)]"
    assert "RocksDB" not in store  # the session is left as it was


# -- loads that count ------------------------------------------------------------


def captures(spark, rows):
    df = spark.createDataFrame(rows, "channel_name string, capture_ord long, text string")
    return df.select("channel_name", "capture_ord", F.parse_json("text").alias("data"))


def test_counts_of_a_load(spark, tmp_path):
    item = lambda **k: {"id": 1, "title": "t", **k}
    rows = [
        ("a", 1, json.dumps({"items": [item(), item(id=2), item(id=0), item(id="")]})), ("b", 2, json.dumps({"items": [item(), {"id": 3}]})),
        ("b", 3, '"nothing"'), ("c", 4, json.dumps({"items": [item(id="x9")]})), ("c", 5, "{}"),
    ]
    path = f"file://{tmp_path}/posts"
    counts = capture.load_counted(captures(spark, rows), path, ["channel_name", "capture_ord"]).first().asDict()
    posts = spark.read.parquet(path).collect()
    assert sorted((r.id, r.channel) for r in posts) == [(1, "a"), (2, "a")]
    assert counts == {"captured": 5, "with_list": 3, "exploded": 7, "guarded": 5, "rejected": 2, "projected": 2}


def test_a_load_without_captures(spark, tmp_path):
    counts = capture.load_counted(captures(spark, []), f"file://{tmp_path}/posts", ["channel_name", "capture_ord"]).first()
    assert set(counts) == {0}


def test_one_scan_counts_and_writes(spark, small, tmp_path):
    """The load reads the captures once: one job reads the orders, and no more rows of them than there are."""
    from townhall.plans import tables as tb

    sc = spark.sparkContext
    sc.setJobGroup("counted load", "counted load")
    try:
        capture.load_counted(tb.captures(spark, small), f"file://{tmp_path}/posts", ["channel_name", "capture_ord"])
        jobs_run = sc.statusTracker().getJobIdsForGroup("counted load")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(glob.glob(f"{tmp_path}/posts/*.parquet")) >= 1
    stages = [s for j in jobs_run for s in sc.statusTracker().getJobInfo(j).stageIds]
    infos = [sc.statusTracker().getStageInfo(s) for s in set(stages)]
    assert sum(1 for i in infos if i and i.numCompletedTasks) <= 3  # schema read, counting map side, writing side


def test_versions_are_compacted(spark, tmp_path):
    """Eleven batches of a running count, with the folders of few of them; going on after a stop."""
    folder, at = f"{tmp_path}/in", jobs.Place(f"{tmp_path}/o", f"{tmp_path}/p")
    for part in range(11):
        rows = [(f"k{(part * 7 + i) % 5}", part * 10 + i, START) for i in range(part + 1)]
        spark.createDataFrame(rows, "kind string, row long, ts timestamp").coalesce(1).write.mode("append").parquet(folder)
        if part in (4, 10):
            counts = by_file(spark, folder).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.max("row").alias("last"))
            out = jobs.run_update(counts, ["kind"], at, compact=3)
            want = spark.read.parquet(folder).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.max("row").alias("last"))
            assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
    assert len(glob.glob(f"{tmp_path}/o/batch=*")) <= 7


# -- late rows -------------------------------------------------------------------


def deliveries(spark, folder, n=6, seed=5, after=lambda: None):
    """Files one after the other; some rows are days behind, each of those alone in its group."""
    rng, row = random.Random(seed), 0
    for part in range(n):
        rows = []
        for _ in range(40):
            rows.append((f"k{rng.randrange(3)}", row, START + dt.timedelta(days=part, seconds=rng.randrange(86_400), microseconds=rng.randrange(10**6))))
            row += 1
        for _ in range(5):
            back = dt.timedelta(days=rng.randrange(2, 5), seconds=rng.randrange(86_400))
            rows.append((f"behind {row}", row, START + dt.timedelta(days=part) - back))
            row += 1
        spark.createDataFrame(rows, "kind string, row long, ts timestamp").coalesce(1).write.mode("append").parquet(folder)
        after()
    return row


def by_file(spark, folder):
    return spark.readStream.schema("kind string, row long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(folder)


def test_late_rows_are_those_that_the_aggregate_drops(spark, tmp_path):
    """Both run once for each delivery, and go on where they stopped."""
    folder, dropped = f"{tmp_path}/in", 0

    def run():
        nonlocal split, dropped
        split = late.run_windows(by_file(spark, folder), "ts", "kind", jobs.Place(f"{tmp_path}/o", f"{tmp_path}/p"))
        plain = jobs.window_counts(by_file(spark, folder), "ts", "kind")
        query = plain.writeStream.outputMode("update").format("noop").option("checkpointLocation", f"{tmp_path}/q").trigger(
            availableNow=True).start()
        query.awaitTermination()
        dropped += sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])

    split = None
    n = deliveries(spark, folder, after=run)
    gone = split.late.collect()
    assert 0 < len(gone) < n and len({r.kind for r in gone}) == len(gone)
    assert split.counts.agg(F.sum("n")).first()[0] + len(gone) == n
    assert dropped == len(gone)
    rows = spark.read.parquet(folder).join(split.late.select("row"), "row", "left_anti")
    want = {(r.w.start, r.kind): r["count"] for r in rows.groupBy(F.window("ts", "1 day").alias("w"), "kind").count().collect()}
    assert {(r.window_start, r.kind): r.n for r in split.counts.collect()} == want


def test_many_batches_leave_few_folders(spark, tmp_path):
    folder, at = f"{tmp_path}/in", jobs.Place(f"{tmp_path}/o", f"{tmp_path}/p")
    n = deliveries(spark, folder, n=12)
    split = late.run_windows(by_file(spark, folder), "ts", "kind", at)
    assert split.counts.agg(F.sum("n")).first()[0] + split.late.count() == n
    again = late.run_windows(by_file(spark, folder), "ts", "kind", at)  # nothing new: nothing changes
    assert again.late.count() == split.late.count()
    for name in ("counts", "mark"):
        assert len(glob.glob(f"{tmp_path}/o/{name}/batch=*")) <= 3
