"""The store in buckets and the tiers of batches: equal to first-wins loading, no shuffle of what is stored, few files."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from townhall.plans.catalogue import CATALOGUE
from townhall.session import scratch_path
from townhall.sources import folders
from townhall.sources.store import PostStore
from townhall.streaming import jobs
from townhall.streaming.jobs import Place, tier_span, tiers_in_use

SCHEMA = "id bigint, at bigint, kind string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def draw(n, seed=3):
    """Rows of which a third share an id, and some have none."""
    rng = random.Random(seed)
    ids = lambda k: None if k % 50 == 0 else 7 if rng.random() < 0.34 else rng.randrange(-300, 900)
    return [(ids(k), k, rng.choice("abc")) for k in range(n)]


def first_of(*batches):
    held = {}
    for batch in batches:
        for ident, at, _ in sorted((r for r in batch if r[0] is not None), key=lambda r: r[1]):
            held.setdefault(ident, at)
    return held


def held(store):
    rows = [(r.id, r.at) for r in store.posts().collect()]
    assert len(rows) == len({i for i, _ in rows})
    return dict(rows)


@pytest.fixture()
def store(spark):
    schema = spark.createDataFrame([], SCHEMA).schema
    return PostStore.open(spark, scratch_path(spark, "t-store"), schema, "id", buckets=4)


def files_of(spark, store):
    return folders.names(spark, f"{store.path}/gen={store.generation()}", "part-")


def test_loads_keep_the_first_copies(spark, store):
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA).repartition(5)
    one, two, three = draw(400), draw(900, 4), draw(700, 5)
    assert held(store) == {}
    store.load(frame(one), ["at"])
    store.load(frame(two), ["at"])
    assert held(store) == first_of(one, two)
    store.load(frame(two), ["at"])  # repeated
    store.compact()
    assert held(store) == first_of(one, two) and len(files_of(spark, store)) == 4
    store.load(frame(three), ["at"])
    assert held(store) == first_of(one, two, three) and len(files_of(spark, store)) <= 8
    store.load(frame([]), ["at"])
    assert held(store) == first_of(one, two, three)


def test_a_broken_off_load_is_made_whole(spark, store):
    rows = draw(600)
    store.load(spark.createDataFrame(rows, SCHEMA), ["at"])
    gone = files_of(spark, store)[1]  # as if the job had ended before this file was moved in place
    folders.remove(spark, f"{store.path}/gen=0/{gone}")
    assert held(store) != first_of(rows)
    store.load(spark.createDataFrame(rows, SCHEMA), ["at"])
    assert held(store) == first_of(rows)


def test_a_generation_counts_when_it_is_whole(spark, store):
    rows = draw(300)
    store.load(spark.createDataFrame(rows, SCHEMA), ["at"])
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{store.path}/gen=1")
    folders.remove(spark, f"{store.path}/gen=1/_SUCCESS")
    assert store.generation() == 0 and held(store) == first_of(rows)
    store.compact()
    assert store.generation() == 1 and held(store) == first_of(rows)
    store.compact()
    assert folders.names(spark, store.path, "gen=") == ["gen=1", "gen=2"]  # one is left for readers


def test_another_session_finds_the_store(spark, store):
    store.load(spark.createDataFrame(draw(200), SCHEMA), ["at"])
    again = PostStore.open(spark.newSession(), store.path, store.schema, "id", 4)
    assert held(again) == first_of(draw(200))
    with pytest.raises(ValueError, match="4 buckets of id"):
        PostStore.open(spark, store.path, store.schema, "id", 8)


def test_odd_names(spark):
    rows = spark.createDataFrame([(1, 5, "x"), (1, 4, "y")], "`the id` bigint, `a.b` bigint, `it's` string")
    odd = PostStore.open(spark, scratch_path(spark, "it's"), rows.schema, "the id", buckets=2)
    odd.load(rows, [F.col("`a.b`")])
    assert [tuple(r) for r in odd.posts().collect()] == [(1, 4, "y")]


def test_what_is_stored_is_not_shuffled(spark, store):
    batch = spark.createDataFrame(draw(300), SCHEMA)
    store.load(batch, ["at"])
    lines = plan(store.fresh(batch, ["at"])).split("\n")
    scan = next(k for k, line in enumerate(lines) if "Bucketed: true" in line)
    join = next(k for k, line in enumerate(lines) if "SortMergeJoin" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    side = max(k for k in range(join + 1, scan) if depth(lines[k]) == depth(lines[join]) + 3)
    assert "id#" in lines[scan] and "ReadSchema: struct<id:bigint>" in lines[scan]
    assert not any("Exchange" in line for line in lines[side:scan])
    assert "Exchange" not in plan(store.posts().groupBy("id").agg(F.max("at")))
    both = store.posts().hint("merge").join(store.posts().withColumnRenamed("at", "other"), "id")
    assert "Exchange" not in plan(both)


def test_lookup_joins_and_groups_in_place(spark, small):
    text = plan(CATALOGUE["stored_lookup"](spark, small))
    assert "Bucketed: true" in text and "hashpartitioning" not in text


# -- tiers -----------------------------------------------------------------------


def test_tiers_hold_every_batch_once():
    written, most = [], 0
    for batch in range(700):
        earlier = tiers_in_use(written)
        span = tier_span(batch, 4)
        assert sorted(b for s, e in earlier for b in range(e - s + 1, e + 1)) == list(range(batch))
        assert all(e - s + 1 > batch - span for s, e in earlier if e > batch - span)  # merged whole
        written.append((span, batch))
        if span > 1:
            old = [t for t in written if t[1] <= batch - 4]
            written = [t for t in written if t not in set(old) - set(tiers_in_use(old))]
        most = max(most, len(written))
    assert most <= 4 * 5 + 4
    assert tiers_in_use([(1, 0), (1, 1), (2, 1)]) == [(2, 1)]  # a batch repeated with another fan


def put(spark, path, rows):
    times = [(i, k, kind, dt.datetime(2024, 1, 1)) for i, k, kind in rows]
    spark.createDataFrame(times, SCHEMA + ", ts timestamp").coalesce(1).write.mode("append").parquet(path)


def test_fifty_batches_leave_few_folders(spark, tmp_path):
    path, at = str(tmp_path / "in"), Place.new(spark, "t-tiers")
    batches = [[(i % 3, 10 * b, "a"), (b // 2, 10 * b + 1, "b"), (-b, 10 * b + 2, "c")] for b, i in enumerate(range(50))]

    def run():
        rows = spark.readStream.schema(SCHEMA + ", ts timestamp").option("maxFilesPerTrigger", 1).parquet(path)
        return jobs.run_new_posts(rows, "id", ["at"], at, buckets=2, fan=4)

    for b in batches[:30]:
        put(spark, path, b)
    assert {r.id for r in run().collect()} == {i for b in batches[:30] for i, _, _ in b}
    for b in batches[30:]:
        put(spark, path, b)
    out = [r.id for r in run().collect()]
    assert sorted(out) == sorted({i for b in batches for i, _, _ in b})
    count = sum(len(folders.names(spark, f"{at.out}/{s}")) for s in folders.names(spark, at.out, "span="))
    assert count <= 4 * 3 + 4
    # a batch that was broken off counts for nothing
    spark.createDataFrame([(10**6, 1, "z")], SCHEMA).write.parquet(f"{at.out}/span=1/batch=50/bucket=0")
    assert len(run().collect()) == len(out)


def test_a_stream_fills_the_store(spark, tmp_path, store):
    path, at = str(tmp_path / "in"), Place.new(spark, "t-stored")
    batches = [draw(60, s) for s in range(5)]
    for b in batches:
        put(spark, path, b)
    rows = lambda: (spark.readStream.schema(SCHEMA + ", ts timestamp").option("maxFilesPerTrigger", 1)
                    .parquet(path).select("id", "at", "kind"))
    jobs.run_stored(rows(), store, ["at"], at, compact=2)
    assert set(held(store)) == set(first_of(*batches)) and store.generation() == 2
    put(spark, path, [(5000, 1, "a")])
    assert jobs.run_stored(rows(), store, ["at"], at, compact=2).where("id = 5000").count() == 1
