"""The plans are the ones meant: pruned scans, early cuts, no needless work."""

import re

import pytest

from townhall.operators import metrics, ranking
from townhall.operators.filters import PostFilter
from townhall.plans import tables as tb
from townhall.plans.catalogue import CATALOGUE


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_list_reads_what_it_shows(spark, small):
    text = plan(ranking.top_posts(tb.posts(spark, small)).select("id", "view_count"))
    assert "TakeOrderedAndProject" in text and "Sort [" not in text
    assert "lineitem" not in text  # the responses are not needed, so they are not read
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_filter_reaches_the_scan(spark, small):
    text = plan(PostFilter(channel="1-URGENT").apply(tb.posts(spark, small)).select("id"))
    assert "EqualTo(o_orderpriority,1-URGENT)" in text


def test_counts_are_added_before_the_shuffle(spark, small):
    text = plan(metrics.monthly_posts(tb.posts(spark, small)))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_distinct_authors_do_not_gather_in_a_channel(spark, small):
    text = plan(metrics.channel_summary(tb.posts(spark, small)))
    assert re.search(r"Exchange hashpartitioning\(channel#\d+, author#\d+", text)
    assert "Expand" not in text


@pytest.mark.parametrize("name", ["capture_posts", "channel_posts", "dedupe_first", "link_dimension"])
def test_dedupe_is_cut_in_every_task(spark, small, name):
    assert plan(CATALOGUE[name](spark, small)).count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", sorted(set(CATALOGUE) - {"stream_dedupe"}))
def test_no_cross_join_and_no_python(spark, small, name):
    if name.startswith("stream_") or name.endswith(("_round_trip", "_csv", "_files", "_partitions")):
        pytest.skip("runs at once")
    text = plan(CATALOGUE[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize("name", [
    "kpi_overview", "kpi_support", "median_response_by_channel", "response_lines", "collocations", "top_terms",
    "chosen_support_figures",
])
def test_planning_starts_no_job_but_schema_reads(spark, small, name):
    """Reading a Parquet schema is a job of its own; no other may run before the result is asked for."""
    sc = spark.sparkContext
    sc.setJobGroup(f"plan-{name}", name)
    try:
        CATALOGUE[name](spark, small)
        tracker = sc.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(f"plan-{name}")
                  for s in tracker.getJobInfo(j).stageIds]
        assert all(s.numTasks == 1 and s.name.startswith("parquet at") for s in stages if s)
        tables = {"collocations": 1, "top_terms": 1}.get(name, 2)
        assert len(tracker.getJobIdsForGroup(f"plan-{name}")) <= tables
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
