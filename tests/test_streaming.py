"""Streams over several files give what the batch operators give."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from townhall.operators import capture
from townhall.operators.identity import keep_first
from townhall.streaming import jobs

place = jobs.Place.new
SCHEMA = "id bigint, row bigint, kind string, value bigint, ts timestamp"


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """Four files, one after the other in time, one id in a third of the rows."""
    folder = tmp_path_factory.mktemp("events")
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 30)
    row = 0
    for part in range(4):
        rows = []
        for _ in range(300):
            ident = 0 if rng.random() < 0.34 else rng.randint(1, 200)
            at = start + dt.timedelta(days=part, seconds=rng.randint(0, 86399))
            rows.append((ident, row, rng.choice("abc"), rng.randint(0, 50), at))
            row += 1
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder / "t"))
    return str(folder / "t")


def stream(spark, path):
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_dedupe(spark, events):
    rows = jobs.run_append(jobs.dedupe(stream(spark, events), "id", "ts", F.col("row"), "100 days"), place(spark, "t-dedupe"))
    ids = [r.id for r in rows.collect()]
    assert len(ids) == len(set(ids))
    assert set(ids) == {r.id for r in spark.read.parquet(events).select("id").distinct().collect()}


def test_first_copies_and_new_posts(spark, events):
    want = {(r.id, r.row, r.kind) for r in keep_first(spark.read.parquet(events), ["id"], ["row"]).collect()}
    out = jobs.run_update(jobs.first_copies(stream(spark, events), "id", "row", ["kind"]), ["id"], place(spark, "t-first"))
    assert {(r.id, r.row, r.kind) for r in out.collect()} == want
    loaded = jobs.run_new_posts(stream(spark, events), "id", ["row"], place(spark, "t-new"))
    ids = [r.id for r in loaded.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == {i for i, _, _ in want}


def test_windows_drop_late_rows(spark, tmp_path):
    path = str(tmp_path / "late")

    def put(day, hour, kind="a"):
        at = dt.datetime(2024, 1, day, hour)
        spark.createDataFrame([(1, 1, kind, 1, at)], SCHEMA).coalesce(1).write.mode("append").parquet(path)

    for day, hour in ((1, 5), (1, 6), (3, 2)):
        put(day, hour)
    out = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    rows = jobs.run_append(jobs.window_counts(out, "ts", "kind"), place(spark, "t-windows")).collect()
    # the last day is still open
    assert [(r.window_start, r.n) for r in rows] == [(dt.datetime(2024, 1, 1), 2)]
    put(3, 3)  # the watermark moves one batch behind the data
    put(1, 7)  # by now later than the watermark
    again = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    rows = jobs.run_append(jobs.window_counts(again, "ts", "kind"), place(spark, "t-windows")).collect()
    assert [(r.window_start, r.n) for r in rows] == [(dt.datetime(2024, 1, 1), 2)]


def test_months_and_figures(spark, events):
    batch = spark.read.parquet(events)
    months = jobs.run_complete(jobs.month_counts(stream(spark, events), "ts", "kind"), place(spark, "t-months"))
    want = batch.groupBy(F.date_trunc("month", "ts").alias("m"), "kind").count()
    assert {tuple(r) for r in months.collect()} == {tuple(r) for r in want.collect()}
    figures = jobs.run_complete(jobs.running_figures(
        stream(spark, events), "value", "id", F.col("value") > 25), place(spark, "t-figures")).first()
    exact = batch.agg(F.count(F.lit(1)), F.sum("value"), F.count_distinct("id")).first()
    assert (figures.n, figures.total) == (exact[0], exact[1])
    assert figures.mean == pytest.approx(exact[1] / exact[0])
    assert figures.answered == batch.where("value > 25").count()
    assert abs(figures.median_about - batch.agg(F.median("value")).first()[0]) <= 1
    assert abs(figures.members_about - exact[2]) <= 0.06 * exact[2]


def test_top(spark, events):
    out = jobs.run_top(stream(spark, events), 7, "value", "row", place(spark, "t-top")).orderBy(F.desc("value"), "row")
    want = spark.read.parquet(events).orderBy(F.desc("value"), "row").limit(7)
    assert [r.row for r in out.collect()] == [r.row for r in want.collect()]


def test_capture_files(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.json").write_text(json.dumps(
            [{"url": "x/mainLayout", "data": {"enrichedContentResources": [{"id": n, "title": "t"}, {"id": n + 10}]}},
             {"url": "other", "data": [1]}]))
    landed = jobs.capture_stream(spark, str(tmp_path), array=True, files_per_batch=1)
    rows = capture.resources(capture.url_contains(landed, "mainLayout"), keep=["url"])
    out = jobs.run_append(capture.project_posts(rows), place(spark, "t-captures"))
    assert sorted(r.id for r in out.collect()) == [0, 1, 2, 10, 11, 12]


def test_nothing_landed(spark, tmp_path):
    (tmp_path / "t").mkdir()
    empty = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "t"))
    assert jobs.run_top(empty, 3, "value", "row", place(spark, "t-none")).count() == 0


def put(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_jobs_go_on_where_they_stopped(spark, tmp_path):
    """Stopped after the first files, run again at the same place over more: as if run once."""
    path, day = str(tmp_path / "in"), dt.datetime(2024, 1, 1)
    places = {n: place(spark, f"t-again-{n}") for n in ("new", "first", "months", "top", "append")}

    def run():
        rows = stream(spark, path)
        return {
            "new": jobs.run_new_posts(rows, "id", ["row"], places["new"], buckets=4),
            "first": jobs.run_update(jobs.first_copies(rows, "id", "row", ["kind"]), ["id"], places["first"]),
            "months": jobs.run_complete(jobs.month_counts(rows, "ts", "kind"), places["months"]),
            "top": jobs.run_top(rows, 3, "value", "row", places["top"]),
            "append": jobs.run_append(rows.select("id", "row"), places["append"]),
        }

    put(spark, path, [(1, 5, "a", 9, day), (2, 6, "b", 3, day)])
    assert run()["new"].count() == 2
    put(spark, path, [(1, 2, "c", 4, day), (3, 7, "a", 8, day)])
    out = run()
    assert sorted((r.id, r.row) for r in out["new"].collect()) == [(1, 5), (2, 6), (3, 7)]
    assert sorted((r.id, r.row, r.kind) for r in out["first"].collect()) == [(1, 2, "c"), (2, 6, "b"), (3, 7, "a")]
    assert sorted((r.kind, r.n) for r in out["months"].collect()) == [("a", 2), ("b", 1), ("c", 1)]
    assert sorted(r.row for r in out["top"].collect()) == [2, 5, 7]
    assert sorted(r.row for r in out["append"].collect()) == [2, 5, 6, 7]
    assert {n: f.count() for n, f in run().items()} == {"new": 3, "first": 3, "months": 3, "top": 3, "append": 4}


def test_a_batch_reads_only_the_buckets_it_touches(spark, tmp_path):
    path, day, at = str(tmp_path / "in"), dt.datetime(2024, 1, 1), place(spark, "t-buckets")
    put(spark, path, [(i, i, "a", 1, day) for i in range(50)])
    put(spark, path, [(7, 99, "b", 1, day), (200, 100, "b", 1, day)])
    out = jobs.run_new_posts(stream(spark, path), "id", ["row"], at, buckets=8)
    assert out.count() == 51 and out.where("id = 7").first().row == 7
    buckets = {r.b for r in spark.read.option("basePath", at.out).parquet(at.out).selectExpr("bucket AS b").collect()}
    assert len(buckets) == 8
