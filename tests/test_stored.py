"""Sets of ids, the cube of filter choices, sketches, bracketed medians and pruned pairs against plain counts."""

import collections
import itertools
import random
import statistics

import pytest
from pyspark.sql import functions as F

from townhall.operators import cube, idsets, metrics, sketches, terms
from townhall.operators.filters import PostFilter
from townhall.operators.medians import bracketed_medians, exact_medians
from townhall.operators.metrics import channel_summary, poster_frequency
from townhall.plans import tables as tb


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- sets of ids ---------------------------------------------------------------

EDGES = [0, 1, -1, 7, 8, 9, 32767, 32768, 32769, -32767, -32768, -32769, 2**63 - 1, -(2**63), 10**18, 10**18 + 1]


def test_every_id_has_a_place_of_its_own(spark):
    ids = spark.createDataFrame([(i,) for i in EDGES], "id long")
    for one in EDGES:
        seen = idsets.id_set(ids.where(F.col("id") == one), "id")
        assert [r.id for r in idsets.unseen(ids, seen, "id").collect()] != [] and one not in {
            r.id for r in idsets.unseen(ids, seen, "id").collect()}
    seen = idsets.id_set(ids, "id")
    assert idsets.unseen(ids, seen, "id").count() == 0 and idsets.size(seen).first()[0] == len(EDGES)


def test_unseen_is_the_anti_join(spark):
    rng = random.Random(4)
    draw = lambda n: [(rng.choice(EDGES + [None]) if k % 5 == 0 else rng.randrange(-70000, 200000), k) for k in range(n)]
    old, new = draw(4000), draw(6000) + [(77, -k) for k in range(3000)]  # one id has a third of the rows
    frame = lambda rows: spark.createDataFrame(rows, "id long, at long").repartition(5)
    known = {i for i, _ in old}
    parts = idsets.id_set(frame(old[:1500]), "id").unionByName(idsets.id_set(frame(old[1500:]), "id"))
    want = collections.Counter((i, k) for i, k in new if i is None or i not in known)
    assert collections.Counter(map(tuple, idsets.unseen(frame(new), parts, "id").collect())) == want
    fresh, added = idsets.load(frame(new), parts, "id", ["at"])
    first = {}
    for i, k in sorted(new, key=lambda r: r[1]):
        if i is not None and i not in known:
            first.setdefault(i, k)
    assert {r.id: r.at for r in fresh.collect()} == first
    assert idsets.size(parts.unionByName(added)).first()[0] == len((known | {i for i, _ in new}) - {None})


def test_without_rows(spark):
    none = spark.createDataFrame([], "id long, at long")
    seen = idsets.id_set(none, "id")
    assert idsets.size(seen).first()[0] == 0 and idsets.unseen(none, seen, "id").count() == 0
    some = spark.createDataFrame([(5, 1), (None, 2)], "id long, at long")
    assert idsets.unseen(some, seen, "id").count() == 2


def test_the_set_is_small_and_loaded_posts_are_not_read(spark, small, tmp_path):
    posts = tb.posts(spark, small).select("id")
    idsets.id_set(posts, "id").write.parquet(f"file://{tmp_path}/seen")
    seen = spark.read.parquet(f"file://{tmp_path}/seen")
    assert seen.count() <= posts.agg(F.max("id")).first()[0] // 32768 + 2
    text = plan(idsets.unseen(spark.range(10).select(F.col("id").alias("id")), seen, "id"))
    assert "orders" not in text and "seen" in text


# -- the cube --------------------------------------------------------------------


@pytest.fixture(scope="module")
def posts(spark, small):
    """Posts with missing channels, types, months and authors."""
    rows = tb.posts(spark, small).where("id < 1200")
    gone = lambda c, n: F.when(F.pmod("id", F.lit(n)) != 0, F.col(c))
    return rows.withColumns({
        "channel": gone("channel", 11), "type_label": gone("type_label", 13), "month": gone("month", 17),
        "author": gone("author", 7), "has_responses": F.pmod("id", F.lit(3)) != 0})


@pytest.fixture(scope="module")
def stored(spark, posts, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('cube')}/cube"
    cube.build(posts).write(path)
    return cube.Cube.read(spark, path)


def test_any_choice_is_answered_as_by_the_posts(spark, posts, stored):
    months = [(), ("1996-01",), ("1996-01", "1996-02", "1997-05", "1998-11", "never")]
    for channel, label, some in itertools.product([None, "1-URGENT", "none"], [None, "Help / Question"], months):
        chosen = PostFilter(channel, label, some)
        shown = chosen.apply(posts)
        want = metrics.support_figures(shown).drop("median_response_hours").first().asDict()
        assert cube.support_figures(stored, chosen).first().asDict() == want, chosen
        assert cube.poster_frequency(stored, chosen).first() == poster_frequency(shown).first(), chosen


@pytest.mark.parametrize("chosen", [
    PostFilter(), PostFilter(months=("1996-01", "1996-02", "1997-05")), PostFilter("1-URGENT", months=("1996-01",)),
    PostFilter(type_label="Share / Resource"),
])
def test_channel_views_are_those_of_the_posts(posts, stored, chosen):
    shown = chosen.apply(posts)
    both = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))
    assert both(cube.channel_summary(stored, chosen), channel_summary(shown))
    assert both(cube.answered_by_channel(stored, chosen), metrics.answered_by_channel(shown))


def test_choices_read_their_slice_only(stored):
    text = plan(cube.support_figures(stored, PostFilter("1-URGENT")))
    assert "PartitionFilters: [isnotnull(slice" in text and "orders" not in text
    assert cube.slice_id("channel", "type_label", "month") == 0 and cube.slice_id() == 7


def test_slices_of_an_author_are_added_up_in_parts_of_bounded_size(posts, stored, monkeypatch):
    monkeypatch.setattr(cube, "AUTHOR_ROWS", 100)
    built = cube.build(posts)
    text = plan(built.members)
    assert "Expand" not in text and text.count("Exchange") == 1 and "hashpartitioning(author" in text
    assert built.members.rdd.getNumPartitions() >= 5
    for mine, kept in ((built.slices, stored.slices), (built.members, stored.members)):
        rows = lambda df: sorted(map(str, df.select(*mine.columns).collect()))
        assert rows(mine) == rows(kept)


def test_cube_without_posts(posts):
    none = cube.build(posts.where("false"))
    assert cube.poster_frequency(none).first() == (0, 0, 0)
    assert cube.support_figures(none).first()["posts"] == 0 and cube.channel_summary(none).count() == 0


# -- sketches --------------------------------------------------------------------


def test_sketches_of_parts_are_within_their_bound(spark):
    rows = spark.range(300_000).select(
        F.concat(F.lit("who "), F.pmod(F.col("id") * 7919, F.lit(90_001))).alias("author"),
        F.concat(F.lit("c"), F.pmod("id", F.lit(3))).alias("channel"), F.concat(F.lit("m"), F.pmod(F.floor(F.col("id") / 1000), F.lit(12))).alias("month"))
    stored = sketches.member_sketches(rows)
    assert stored.count() == 36
    for some in ([f"m{i}" for i in range(12)], ["m1", "m2"], ["m5"]):
        exact = rows.where(F.col("month").isin(some)).select("author").distinct().count()
        about = sketches.members_about(stored.where(F.col("month").isin(some))).first()[0]
        assert abs(about - exact) <= 4 * sketches.STANDARD_ERROR * exact
    assert sketches.members_about(stored.where("false")).first()[0] == 0


# -- medians inside a bracket ----------------------------------------------------


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_bracketed_medians_are_exact(spark, accuracy):
    rng = random.Random(accuracy)
    draws = {
        "flat": [rng.randrange(10**6) for _ in range(5001)], "one": [7], "two": [3, 8], "ties": [5] * 900 + [6] * 900,
        "wide": [rng.choice([-(2**62), 2**62, 0, 1]) for _ in range(1000)], "none": [None, None], None: [1, 2, None, 10],
        "hot": [min(rng.randrange(10**4), 4000) for _ in range(6000)],
    }
    rows = [(g, v) for g, values in draws.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v long").repartition(6)
    want = {g: statistics.median(map(float, [v for v in values if v is not None])) for g, values in draws.items() if g not in ("none", None)}
    found = bracketed_medians(df, F.col("v"), ["g"], accuracy=accuracy)
    assert {r.g: r["median"] for r in found.collect()} == want
    assert {r.g: r["m"] for r in exact_medians(df, {"m": F.col("v")}, ["g"]).collect()} == want
    assert bracketed_medians(df.where("false"), F.col("v"), ["g"]).count() == 0


def test_a_bracket_that_misses_is_counted_anew(spark, monkeypatch):
    df = spark.range(3001).select((F.col("id") * 3).alias("v"), F.lit("a").alias("g"))
    real = F.percentile_approx
    monkeypatch.setattr(F, "percentile_approx", lambda c, p, a: F.transform(real(c, p, a), lambda x: x + 500))
    assert bracketed_medians(df, F.col("v"), ["g"]).first()["median"] == 4500.0


# -- pruned pairs ----------------------------------------------------------------


def test_no_pair_above_the_threshold_is_pruned(spark, small):
    text = spark.read.parquet(f"{small}/documents.parquet").select("text")
    singles, pairs = terms._vocabulary(text, "text", terms.REPORT_STOPWORDS)
    every = {r.bigram: r for r in terms.scored_bigrams(text, "text", terms.REPORT_STOPWORDS).collect()}
    for frequent, threshold in ((200, 30), (200, 8), (5000, 30), (0, 30)):
        kept = {r.bigram for r in terms.worth_scoring(singles, pairs, threshold, frequent).collect()}
        assert {b for b, r in every.items() if r.score > threshold} <= kept
    assert len(kept) <= len(every)
    assert len({r.bigram for r in terms.worth_scoring(singles, pairs, 30, 5000).collect()}) <= len(every) / 2
    # the condition holds one score, whatever the corners: with four of them its code is not compiled
    text = plan(terms.worth_scoring(singles, pairs, 30, 5000)).lower()
    line = max(text.split("\n"), key=lambda x: x.count("ln(") + x.count("log("))
    assert 0 < line.count("ln(") + line.count("log(") <= 8
    rows = terms.worth_scoring(singles, pairs, 30, 5000)
    assert rows.count() == rows.select("key_1", "key_2").distinct().count()


def test_the_bound_holds_everywhere_in_its_ranges(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(3000):
        total = rng.choice([500, 10**5, 10**8])
        k = rng.randrange(1, 40)
        hi = [rng.randrange(k, max(k + 1, total // 3)) for _ in range(2)]
        rows.append((k, *[rng.randint(k, h) for h in hi], *hi, total))
    df = spark.createDataFrame(rows, "k long, a long, b long, ha long, hb long, t long")
    c = F.col
    score = terms.collocation_score(c("k"), c("a"), c("b"), c("t"))
    bound = terms.score_bound(c("k"), (c("k"), c("ha")), (c("k"), c("hb")), c("t"))
    assert df.where(c("a") + c("b") - c("k") <= c("t")).where(score > bound).count() == 0
