"""Typing, filters, metrics, distributions and top lists on small frames, against pandas."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from townhall.functions import dates, labels, numbers
from townhall.operators import distributions, filters, metrics, ranking
from townhall.operators.filters import PostFilter
from townhall.operators.typed import multi_channel_posts, single_community_posts
from townhall.plans.dashboard import dashboard
from townhall.plans.report import report

# The known view counts and months of the 19 posts.
VIEWS = [5548, 3114, 2905, 2514, 2495, 2044, 1531, 1411, 1278, 943, 600, 500, 400, 300, 200, 150, 100, 52, 40]
MONTHS = ["2020-02", "2022-02", "2022-03", "2022-09", "2023-04", "2023-04", "2023-07", "2023-07", "2023-07",
          "2023-08", "2023-08", "2024-03", "2024-07"] + ["2026-04"] * 6


def raw_rows():
    """19 invented posts with the known view counts and months."""
    rng = np.random.default_rng(11)
    hours = [1.3875, 23644.604166666668] + [float(h) for h in rng.integers(2, 3000, 16)] + [None]
    rows = []
    for i, (views, month) in enumerate(zip(VIEWS, MONTHS)):
        created = dt.datetime.fromisoformat(f"{month}-10T08:00:00")
        last = created + dt.timedelta(hours=hours[i]) if hours[i] is not None else None
        rows.append({
            "id": 100 + i,
            "title": f"How do I &quot;move&quot; item {i}? " + "x" * (i * 5),
            "body": f"<p>Please&nbsp;help {i}</p>" if i % 4 else None,
            "author": f"Person {min(i, 16)} ",
            "type": ["helpQuestion", "helpQuestion", "sharePost", "liveSession", "poll"][i % 5],
            "channel": ["General", "Maths", "Art"][i % 3] if i != 7 else None,
            "created_date": created.isoformat() + "Z",
            "last_response": (last.isoformat() + "Z") if last and i != 5 else "0001-01-01T00:00:00Z",
            "last_responder": "Helper ",
            "view_count": str(views),
            "response_count": str(i % 4) if i % 6 else "none",
            "reply_count": "0",
            "reaction_count": str((i * 7) % 5),
            "has_answer": "true",
            "is_anonymous": ["True", "False", "yes", None][i % 4],
        })
    return rows


@pytest.fixture(scope="module")
def raw(spark):
    rows = raw_rows()
    names = list(rows[0])
    schema = "id bigint, " + ", ".join(f"{n} string" for n in names[1:])
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema).repartition(3)


@pytest.fixture(scope="module")
def posts(raw):
    return multi_channel_posts(raw).cache()


@pytest.fixture(scope="module")
def frame(posts):
    return posts.toPandas().sort_values("id").reset_index(drop=True)


def test_typing_against_pandas(raw, posts, frame):
    base = pd.DataFrame(raw_rows())
    count = pd.to_numeric(base.response_count, errors="coerce").fillna(0).astype(int)
    assert frame.response_count.tolist() == count.tolist()
    assert frame.view_count.sum() == 26125 and frame.view_count.median() == 943
    created = pd.to_datetime(base.created_date, errors="coerce", utc=True)
    last = pd.to_datetime(base.last_response, errors="coerce", utc=True, format="ISO8601")
    last[last.dt.year < 2000] = pd.NaT
    hours = (last - created).dt.total_seconds() / 3600
    assert np.allclose(frame.latest_response_hours, hours, equal_nan=True)
    assert frame.month.tolist() == MONTHS
    assert frame.type_label.tolist()[:5] == [
        "Help / Question", "Help / Question", "Share / Resource", "Live Session", "poll"]
    assert frame.is_anonymous.tolist()[:4] == [True, False, True, False]
    assert frame.author[0] == "Person 0" and frame.channel[7] == "" and frame.body[0] == ""
    assert frame.title[0] == 'How do I "move" item 0?'
    assert all(len(t) <= 56 for t in frame.short_title) and frame.short_title[18].endswith("…")
    single = single_community_posts(raw).select("id", "last_response", "title").orderBy("id").collect()
    assert single[5].last_response is None  # out of range either way
    assert single[0].title.startswith("How do I &quot;")


def test_number_coercion(spark):
    texts = ["12", "12.7", " 12 ", "1e3", "-3.9", "+5", "abc", "", None, "NaN", "inf", "-inf", "1d", "1f", "1,000",
             "true", ".5", "5.", "1e400", "9007199254740993", "99999999999999999999", "0x10"]
    want = [12, 12, 12, 1000, -3, 5, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 5, 0, 9007199254740993, 0, 0]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = df.select("i", numbers.to_count(F.col("t")).alias("n")).orderBy("i").collect()
    assert [r.n for r in got] == want


def test_timestamps(spark):
    texts = ["2026-04-29T00:55:35Z", "2026-04-29T00:55:35.123Z", "2026-04-29T02:55:35+02:00", "2026-04-29",
             "0001-01-01T00:00:00Z", "1999-12-31T23:59:59Z", "", "bad", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    parsed = dates.parse_timestamp(F.col("t"))
    got = df.select("i", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss.SSS").alias("p"),
                    dates.not_before(parsed).isNotNull().alias("real")).orderBy("i").collect()
    assert [r.p for r in got] == [
        "2026-04-29 00:55:35.000", "2026-04-29 00:55:35.123", "2026-04-29 00:55:35.000", "2026-04-29 00:00:00.000",
        None, "1999-12-31 23:59:59.000", None, None, None]
    assert [r.real for r in got] == [True] * 4 + [False] * 5


def test_percent_and_rounding(spark):
    df = spark.createDataFrame([(29, 100), (0, 0), (5, 1), (-1, 2), (1, 8)], "a int, b int")
    got = df.select(
        numbers.percent_floor(F.col("a"), F.col("b")), numbers.percent_even(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [int(a / max(b, 1) * 100) for a, b in [(29, 100), (0, 0), (5, 1), (-1, 2), (1, 8)]]
    assert [r[1] for r in got] == [29, 0, 500, -50, 12]
    halves = [0.05, 0.15, 0.25, 2.5, 10.45]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(halves)], "i int, x double")
    got = [r[1] for r in df.select("i", numbers.round_even(F.col("x"), 1)).orderBy("i").collect()]
    assert got == pd.Series(halves).round(1).tolist()


def test_flags(spark):
    texts = ["True", "true", "1", "yes", "YES", "0", "no", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r[1] for r in df.select("i", labels.truthy_text(F.col("t"))).orderBy("i").collect()]
    assert got == [True] * 5 + [False] * 3


def test_filters(posts, frame):
    all_months = tuple(sorted(set(MONTHS)))
    assert PostFilter().apply(posts).count() == 19
    assert PostFilter(months=all_months).apply(posts).count() == 19
    chosen = PostFilter("Maths", labels.QUESTION, ("2026-04", "2022-02"))
    want = frame[(frame.channel == "Maths") & (frame.type_label == labels.QUESTION)
                 & frame.month.isin(["2026-04", "2022-02"])]
    assert sorted(r.id for r in chosen.apply(posts).collect()) == sorted(want.id)
    assert [r.option for r in filters.options(posts, "month").collect()] == list(all_months)
    assert {(r.filter, r.option) for r in filters.filter_options(posts).collect()} == {
        (c, v) for c in ("channel", "type_label", "month") for v in frame[c].unique()}


def test_overview(posts, frame):
    got = metrics.overview(posts).first()
    assert (got.posts, got.total_views, got.mean_views, got.median_views) == (19, 26125, 1375.0, 943.0)
    assert got.total_responses == frame.response_count.sum() and got.answered == 19
    assert got.authors == frame.author.nunique() == 17
    assert got.mean_response_hours == pytest.approx(frame.latest_response_hours.mean())
    lines = metrics.response_lines(posts).first()
    assert lines.median_hours == pytest.approx(frame.latest_response_hours.median())
    text = metrics.overview_text(metrics.overview(posts)).first()
    assert (text.total_views, text.mean_views, text.median_views, text.answered, text.answered_short) == (
        "26,125", "1375", "943", "19 / 19", "19/19")


def test_support_figures(posts, frame):
    got = metrics.support_figures(posts).first()
    rows = frame.to_dict("records")
    asked = [r for r in rows if r["type_label"] == labels.QUESTION]
    with_reply = sum(1 for r in asked if r["has_responses"])
    rate = 100 * with_reply // len(asked)
    hours = sorted(r["latest_response_hours"] for r in rows if r["latest_response_hours"] > 0)
    middle = (hours[(len(hours) - 1) // 2] + hours[len(hours) // 2]) / 2
    assert (got.posts, got.questions, got.response_rate, got.unanswered_rate) == (19, len(asked), rate, 100 - rate)
    assert got.median_response_hours == pytest.approx(middle)
    assert got.channels == len({r["channel"] for r in rows if r["channel"] is not None})


def test_rollups(posts, frame):
    got = {r.channel: r for r in metrics.channel_summary(posts).collect()}
    for channel, part in frame.groupby("channel"):
        asked = int((part.type_label == labels.QUESTION).sum())
        still = int((~part.has_responses).sum())
        rate = round((asked - still) / (asked or 1) * 100)
        row = got[channel]
        assert (row.posts, row.total_views, row.questions, row.unanswered, row.authors, row.response_rate) == (
            len(part), part.view_count.sum(), asked, still, part.author.nunique(), f"{rate}%")
    freq = frame.groupby("author").size()
    row = metrics.poster_frequency(posts).first()
    assert (row.authors, row.one_time, row.repeat) == (17, int((freq == 1).sum()), int((freq > 1).sum()))
    assert metrics.anonymous_posts(posts).first().anonymous == int(frame.is_anonymous.sum())
    share = {r.type_label: r.share for r in metrics.type_share(posts).collect()}
    assert share == pytest.approx((frame.groupby("type_label").size() / 19 * 100).to_dict())
    answered = {r.channel: (r.questions, r.unanswered, r.answered) for r in metrics.answered_by_channel(posts).collect()}
    q = frame[frame.type_label == labels.QUESTION]
    assert answered == {c: (len(p), int((~p.has_responses).sum()), int(p.has_responses.sum()))
                        for c, p in q.groupby("channel")}
    slow = frame[frame.latest_response_hours > 0]
    want = slow.groupby("channel").latest_response_hours.median().round(1).to_dict()
    assert {r.channel: r.median_hours for r in metrics.median_response_by(posts).collect()} == pytest.approx(want)


def test_null_keys_are_dropped(spark):
    df = spark.createDataFrame(
        [(1, "a", None, 1, 2, "t"), (2, None, None, 3, 4, None), (3, "a", "2024-01", 5, 6, None)],
        "id int, author string, month string, view_count int, response_count int, title string")
    assert [(r.author, r.posts, r.total_views) for r in metrics.author_activity(df).collect()] == [("a", 1, 6)]
    assert [(r.month, r.posts) for r in metrics.monthly_posts(df).collect()] == [("2024-01", 1)]


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(5)
    for values in ([*rng.exponential(50, 300)], [1.0, 2.0, 3.0, 11.0], [4.0, 4.0], [7.0],
                   [float(x) for x in range(11)]):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "h double")
        rows = distributions.histogram(df, "h").orderBy("bin").collect()
        counts, edges = np.histogram(values, bins=10)
        assert [r.n for r in rows] == counts.tolist()
        assert np.allclose([r.left_edge for r in rows] + [rows[-1].right_edge], edges)
    empty = spark.createDataFrame([], "h double")
    assert distributions.histogram(empty, "h").count() == 0
    assert distributions.rounded_histogram(empty, "h").count() == 0


def test_rounded_histogram(spark):
    df = spark.createDataFrame([(float(v),) for v in [3, 14, 55, 61, 97]], "h double")
    rows = distributions.rounded_histogram(df, "h").orderBy("left_edge").collect()
    assert [(r.left_edge, r.right_edge, r.n) for r in rows] == [
        (10.0 * k, 10.0 * k + 10, n) for k, n in enumerate([1, 1, 0, 0, 0, 1, 1, 0, 0, 1])]
    one = spark.createDataFrame([(5.0,), (5.0,)], "h double")
    assert [r.n for r in distributions.rounded_histogram(one, "h").collect()] == [2]


def test_top_lists(posts, frame):
    want = frame.nlargest(10, "view_count").id.tolist()
    assert [r.id for r in ranking.top_posts(posts).collect()] == want
    q = frame[frame.type_label == labels.QUESTION]
    want = q[~q.has_responses].nlargest(10, "view_count").sort_values("view_count").id.tolist()
    got = ranking.ascending(ranking.top_unanswered(posts), "view_count").collect()
    assert [r.id for r in got] == want
    hardest = ranking.hardest_question(posts).first()
    top = q[~q.has_responses].nlargest(1, "view_count").iloc[0]
    assert (hardest.title, hardest.view_count) == (top.title[:55], top.view_count)
    none = ranking.hardest_question(posts.where("false")).first()
    assert (none.title, none.view_count) == ("—", 0)
    tally = {}
    for r in frame.to_dict("records"):
        n, views = tally.get(r["author"], (0, 0))
        tally[r["author"]] = (n + 1, views + r["view_count"])
    busiest = sorted(tally, key=lambda a: (-tally[a][0], a))[:15]
    rows = ranking.top_authors(posts).orderBy("rank").collect()
    assert [(r.rank, r.author) for r in rows] == list(enumerate(busiest, 1))
    want = sorted(busiest, key=lambda a: (-tally[a][1], a))[:12]
    assert [r.author for r in ranking.top_authors_by_views(posts).collect()] == want


def test_ties_and_short_lists(spark):
    df = spark.createDataFrame([(3, 5), (1, 5), (2, 5), (4, 9)], "id int, view_count int")
    assert [r.id for r in ranking.top_posts(df, 3).collect()] == [4, 1, 2]
    assert [r.id for r in ranking.top_posts(df, 99).collect()] == [4, 1, 2, 3]


def test_whole_reports_also_on_nothing(posts):
    texts = posts.withColumn("body", F.coalesce("body", F.lit("")))
    sections = {**report(texts), **dashboard(texts)}
    for name, df in sections.items():
        assert df.count() > 0, name
    chosen = PostFilter(channel="no such channel")
    for name, df in dashboard(texts, chosen).items():
        rows = df.collect()
        assert all(r is not None for r in rows), name
    assert dashboard(texts, chosen)["support_figures"].first().response_rate == 0


def test_mean_of_sums_beyond_64_bits(spark):
    huge = 2**62
    df = spark.range(8).select(F.lit(huge).alias("latest_response_micros"))
    row = metrics.response_lines(df).first()
    assert row.mean_hours == row.median_hours == huge / 3.6e9
