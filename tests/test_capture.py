"""List discovery, guards, projection and flattening on awkward payloads."""

import json

import pytest
from pyspark.sql import functions as F

from townhall.functions import payloads
from townhall.operators import capture, identity
from townhall.schema import CHANNEL_POST_COLUMNS, POST

A, B = {"id": 1, "t": "a"}, {"id": 2, "t": "b"}
URL = "https://h/mainLayout/data?channelSlugName=x&batchNumber=1"

PAYLOADS = [
    [A, B],                                              # 0 root list
    {"data": [A], "results": [B]},                       # 1 first key wins
    {"data": [], "items": [A]},                          # 2 earlier key holds an empty list
    {"items": {"id": 3}, "posts": [A]},                  # 3 key holds an object
    {"a": {"results": [A]}, "b": {"items": [B, A]}},     # 4 two nested matches
    {"a": {"results": []}, "b": "x", "c": None},         # 5 nested, nothing in it
    "text",                                              # 6
    7,                                                   # 7
    None,                                                # 8
    ["x", A],                                            # 9 first element is no object
    [],                                                  # 10
    {"allContent": [A, "x", {"t": 1}], "data": [B]},     # 11 elements without id
    {"conversations": [B], "allContent": [A]},           # 12 key preference differs by rule
    {"a": {"data": [A]}},                                # 13 nested key not looked for
]


@pytest.fixture(scope="module")
def captures(spark):
    rows = [(i, URL, json.dumps(p)) for i, p in enumerate(PAYLOADS)]
    return spark.createDataFrame(rows, "capture_ord int, url string, raw string").select(
        "capture_ord", "url", F.parse_json("raw").alias("data"))


def by_capture(df):
    out = {}
    for r in df.select("capture_ord", "pos", payloads.field(F.col("item"), "id", "bigint").alias("id")).collect():
        out.setdefault(r.capture_ord, []).append((r.pos, r.id))
    return {k: [i for _, i in sorted(v, key=lambda x: x[0])] for k, v in out.items()}


def test_any_list(captures):
    got = by_capture(capture.records(captures))
    assert got == {0: [1, 2], 1: [1], 3: [1], 11: [2], 12: [2]}


def test_records_can_be_unique(captures):
    rows = capture.records(captures, unique_by=["capture_ord"])
    assert sorted(r.capture_ord for r in rows.collect()) == [0, 0]  # ids 1 and 2


def test_conversation_list(captures):
    got = by_capture(capture.conversations(captures))
    assert got == {0: [1, 2], 1: [2], 2: [1], 3: [1], 4: [2, 1], 9: [1], 11: [1], 12: [1]}


def test_usable_ids(spark):
    cases = {
        '{"id": 1}': True, '{"id": "k"}': True, '{"id": "0"}': True, '{"id": 0}': False, '{"id": 0.0}': False,
        '{"id": -0.0}': False, '{"id": ""}': False, '{"id": null}': False, '{"id": false}': False, '{"id": true}': True,
        '{"id": []}': False, '{"id": [0]}': True, '{"id": {}}': False, '{"id": {"a": 1}}': True, '{"x": 1}': False,
        '[{"id": 1}]': False, '"id"': False, "5": False, "null": False, '{"id": 0.5}': True, '{"id": 10}': True,
    }
    df = spark.createDataFrame([(k,) for k in cases], "j string").repartition(2)
    got = df.select("j", capture.has_usable_id(F.parse_json("j")).alias("ok")).collect()
    assert {r.j: r.ok for r in got} == cases


def resource(**kw):
    return {"id": 6, "title": "T", **kw}


def test_projection_defaults(spark):
    items = [
        resource(bodyHTML="<p>a &amp; <b>b</b></p>", channel={"name": "C"}, reactionSummary={"reactionCount": 4},
                 viewCount=9, isArchived=True, authorName="N"),
        resource(reactionSummary=None, channel=None, viewCount=None, bodyHTML=None),
        resource(channel="not an object", viewCount="12"),
        {"id": 7},
        {"title": "no id"},
    ]
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(items)], "ord int, j string").select(
        "ord", F.parse_json("j").alias("item"))
    rows = {r.ord: r for r in capture.project_posts(df, ["ord"]).collect()}
    assert capture.project_posts(df).columns == POST.fieldNames()
    assert (rows[0].body, rows[0].channel, rows[0].reaction_count, rows[0].view_count, rows[0].is_archived,
            rows[0].author) == ("a &amp; b", "C", 4, 9, True, "N")
    assert (rows[1].body, rows[1].channel, rows[1].reaction_count, rows[1].view_count, rows[1].has_answer) == (
        "", "", 0, 0, False)
    assert (rows[2].channel, rows[2].view_count, rows[2].created_date) == ("", 12, "")
    good, bad = capture.split_rejects(df)
    assert sorted(r.ord for r in good.collect()) == [0, 1, 2]
    assert sorted(r.ord for r in bad.collect()) == [3, 4]


def test_channel_projection(spark):
    items = [resource(bodyHTML="", body="plain &lt;i&gt;x", title="a&nbsp; b"), resource(bodyHTML="<p>h</p>", body="no")]
    df = spark.createDataFrame([(f"C{i}", json.dumps(x)) for i, x in enumerate(items)], "channel_name string, j string")
    df = df.select("channel_name", F.parse_json("j").alias("item"))
    rows = capture.project_channel_posts(df).orderBy("channel").collect()
    assert rows[0].__fields__ == CHANNEL_POST_COLUMNS
    assert [(r.channel, r.title, r.body) for r in rows] == [("C0", "a b", "plain x"), ("C1", "T", "h")]


def test_flatten(spark):
    df = spark.sql("""SELECT 1 AS id, named_struct('b', named_struct('c', 2, 'd', array('x', 'y')), 'e', 'z') AS a,
                             array(named_struct('k', 1)) AS l, map('m', 1) AS mm""")
    row = capture.flatten(df).first()
    assert row.asDict() == {"a_b_c": 2, "a_b_d": '["x","y"]', "a_e": "z", "id": 1, "l": '[{"k":1}]', "mm": '{"m":1}'}


def test_flatten_payloads_unions_keys(spark):
    texts = ['{"id": 1, "a": {"b": "x"}}', '{"id": 2, "tags": ["q"], "n": null}', '{"id": 3.5, "a": {"c": true}}']
    df = spark.createDataFrame([("u", t) for t in texts], "url string, j string").select(
        "url", F.parse_json("j").alias("item"))
    out = capture.flatten_payloads(df)
    assert out.columns == ["_source", "a_b", "a_c", "id", "n", "tags"]
    rows = sorted((tuple(r) for r in out.collect()), key=lambda r: float(r[3]))
    assert [(r[0], r[1], r[2], float(r[3]), r[4], r[5]) for r in rows] == [
        ("u", "x", None, 1.0, None, None), ("u", None, None, 2.0, None, '["q"]'), ("u", None, True, 3.5, None, None)]


def test_profile_counts_and_url_rules(spark, captures):
    got = {r.capture_ord: r["keys"] for r in capture.payload_profile(captures).collect()}
    assert [got[i] for i in (0, 1, 4, 6, 7, 8)] == ["list", "data,results", "a,b", "str", "int", "NoneType"]
    urls = [(1, "mainLayout/data?batchNumber=1&channel=a"), (2, "mainLayout/data?batchNumber=2&channel=a"),
            (0, "mainLayout/data?channelSlugName=b&batchNumber=1&z=1"), (3, "other?batchNumber=1&channel=a")]
    df = spark.createDataFrame(urls, "ord int, url string")
    assert capture.page_templates(df, "ord").first().url == "mainLayout/data?channelSlugName=b&z=1"
    logs = spark.createDataFrame([("application/json",), ("text/html",), ("image/png",), (None,)], "ct string")
    assert capture.content_type_has(logs, "json").count() == 1
    assert capture.content_type_has(logs, "json", "javascript", "text").count() == 2


def test_keep_first_and_incremental(spark):
    df = spark.createDataFrame(
        [(1, 5, "late"), (1, 2, "first"), (2, 1, "only"), (None, 1, "n1"), (None, 0, "n0")], "id int, ord int, x string")
    assert {(r.id, r.x) for r in identity.keep_first(df, ["id"], ["ord"]).collect()} == {
        (1, "first"), (2, "only"), (None, "n0")}
    seen = spark.createDataFrame([(2, 0, "old"), (2, 0, "old again")], "id int, ord int, x string")
    batch = df.where("id is not null")
    assert {r.x for r in identity.new_rows(batch, seen).collect()} == {"late", "first"}
    assert {r.x for r in identity.append_new(seen, batch, ["ord"]).collect()} == {"old", "old again", "first"}


def test_hot_key_dedupe_is_cut_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    out = identity.keep_first(df, ["k"], ["id"])
    assert out.count() == 20001  # ids 1, 2, 4, 5, ... and the hot key 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_channels(spark):
    links = spark.createDataFrame(
        [("https://h/channels/a?x", " Alpha ", 1), ("/channels/b", " ", 2), ("/channels/a", "Again", 3), ("/x", "X", 4),
         ("/channels/", "none", 5)], "href string, text string, ord int")
    found = identity.channels_from_links(links)
    body = {"channels": [{"slugName": "b", "name": "From list"}, {"slug": "c"}, 5, {"name": "no slug"}],
            "myChannels": {"slug": "x"}, "enrolledChannels": [{"slugName": "", "slug": "d", "name": "D"}],
            "communityChannels": [{"slug": "d", "name": "second"}]}
    listed = spark.createDataFrame([(1, json.dumps(body)), (2, "[1]")], "capture_ord int, j string").select(
        "capture_ord", F.parse_json("j").alias("data"))
    out = identity.channel_dimension(found, identity.channels_from_payloads(listed))
    assert {(r.slug, r.name, r.href) for r in out.collect()} == {
        ("a", "Alpha", "https://h/channels/a?x"), ("b", "b", "/channels/b"), ("c", "c", ""), ("d", "D", "")}


def test_profile_keeps_all_keys(spark):
    many = ", ".join(f'"k{i:02}": 1' for i in range(14))
    df = spark.sql(f"""SELECT parse_json('{{{many}}}') AS data""")
    assert len(capture.payload_profile(df).first()["keys"].split(",")) == 14


def test_records_without_id_are_no_copies(spark):
    df = spark.sql("""SELECT 1 AS ord, parse_json('[{"id": 1}, {"x": 1}, {"x": 1}, {"id": 1}, {"x": 2}]') AS data""")
    rows = capture.records(df, ["ord"], unique_by=["ord"])
    assert sorted(r.pos for r in rows.collect()) == [0, 1, 2, 4]


def test_ids_that_are_no_whole_numbers_are_rejected_by_name(spark):
    df = spark.sql("""SELECT explode(array(parse_json('{"id": 7, "title": "t"}'), parse_json('{"id": "k5", "title": "t"}'),
        parse_json('{"id": 12.5, "title": "t"}'), parse_json('{"id": null}'), parse_json('{"title": "t"}'))) AS item""")
    good, bad = capture.split_rejects(df)
    assert good.count() == 1
    assert sorted(tuple(r.problems) for r in bad.collect()) == [
        ("id",), ("id", "title"), ("id type",), ("id type",)]


def test_ids_as_large_as_a_bigint_are_kept(spark):
    df = spark.sql("""SELECT explode(array(parse_json('{"id": 1000000000000000000, "title": "t"}'),
        parse_json('{"id": 9223372036854775807, "title": "t"}'), parse_json('{"id": -9223372036854775808, "title": "t"}'),
        parse_json('{"id": "9223372036854775806", "title": "t"}'), parse_json('{"id": 9223372036854775808, "title": "t"}'),
        parse_json('{"id": "+5", "title": "t"}'))) AS item""")
    good, bad = capture.split_rejects(df)
    assert sorted(int(r.id) for r in good.select(capture.item_id().alias("id")).collect()) == [
        -2**63, 10**18, 2**63 - 2, 2**63 - 1]
    assert [tuple(r.problems) for r in bad.collect()] == [("id type",)] * 2


def test_too_many_columns_raise(spark):
    many = ", ".join(f'"k{i}": 1' for i in range(12))
    df = spark.sql(f"""SELECT parse_json('{{{many}}}') AS item, 'u' AS url""")
    with pytest.raises(ValueError, match="12 columns"):
        capture.payload_schema(df, most=11)
    assert capture.top_level_keys(df).count() == 12
