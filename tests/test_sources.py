"""Readers and writers round-trip."""

import json

from pyspark.sql import functions as F

from townhall.operators.typed import multi_channel_posts, single_community_posts
from townhall.schema import CHANNEL_POST_COLUMNS, POST
from townhall.sources import files
from townhall.sources.links import page_links


def post(i, **kw):
    base = {"id": i, "title": f"T{i}", "body": "", "author": "A", "type": "helpQuestion", "channel": "C",
            "created_date": "2024-01-01T00:00:00Z", "last_response": "2024-01-01T06:00:00Z", "last_responder": "R ",
            "view_count": 5, "response_count": 1, "reply_count": 0, "reaction_count": 2, "has_answer": True,
            "is_anonymous": False, "is_archived": False}
    return {**base, **kw}


def test_json_array(spark, tmp_path):
    path = tmp_path / "posts.json"
    path.write_text(json.dumps([post(6755399441055744), post(2, view_count="abc", title=None)], indent=2))
    df = files.read_posts_json(spark, str(path), array=True)
    assert df.columns == POST.fieldNames()
    rows = {r.id: r for r in single_community_posts(df).collect()}
    assert rows[6755399441055744].latest_response_hours == 6.0 and rows[6755399441055744].has_answer is True
    assert rows[2].view_count == 0 and rows[2].title is None


def test_csv_quotes_newlines_and_missing(spark, tmp_path):
    path = str(tmp_path / "csv")
    texts = ['say "hi", ok', "two\nlines", "comma, here", "NaN", "NULL", "", "é😀"]
    rows = [tuple({**post(i), "title": t}[c] for c in CHANNEL_POST_COLUMNS) for i, t in enumerate(texts)]
    schema = ", ".join(f"{c} {POST[c].dataType.simpleString()}" for c in CHANNEL_POST_COLUMNS)
    files.write_csv(spark.createDataFrame(rows, schema), path, CHANNEL_POST_COLUMNS)
    back = files.read_posts_csv(spark, path, multiline=True)
    got = {r.id: r.title for r in back.collect()}
    assert got == {0: texts[0], 1: texts[1], 2: texts[2], 3: None, 4: None, 5: None, 6: texts[6]}
    typed = {r.id: r for r in multi_channel_posts(back).collect()}
    assert typed[1].title == "two lines" and typed[3].title == "" and typed[0].last_responder == "R"


def test_captures_keep_their_order(spark, tmp_path):
    for name, ids in (("2024-01-01.json", [3, 1]), ("2024-01-02.json", [2, 3])):
        (tmp_path / name).write_text(json.dumps(
            [{"url": f"u{i}", "data": {"enrichedContentResources": [{"id": i, "src": name}]}} for i in ids]))
    df = files.read_captures(spark, str(tmp_path), array=True)
    assert [r.url for r in df.orderBy("capture_ord").collect()] == ["u3", "u1", "u2", "u3"]
    assert files.read_captures(spark, str(tmp_path), array=True, ordered=False).columns == ["url", "data"]


def test_flat_csv_raw_and_partitions(spark, tmp_path):
    nested = spark.sql("SELECT 1 AS id, named_struct('b', 'x', 'c', array(1, 2)) AS a")
    files.write_flat_csv(nested, str(tmp_path / "flat"))
    assert spark.read.options(**files.CSV_OPTIONS).csv(str(tmp_path / "flat")).first().asDict() == {
        "a_b": "x", "a_c": "[1,2]", "id": "1"}
    raw = spark.sql("""SELECT 'u' AS url, parse_json('{"id": 1, "x": [null, "é"]}') AS item""")
    files.write_raw(raw, str(tmp_path / "raw"))
    back = files.read_raw(spark, str(tmp_path / "raw"))
    assert back.select(F.to_json("item").alias("j")).first().j == '{"id":1,"x":[null,"é"]}'
    months = spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "id int, month string")
    files.write_posts(months, str(tmp_path / "posts"))
    one = spark.read.parquet(str(tmp_path / "posts")).where("month = '2024-02'")
    assert [r.id for r in one.collect()] == [2]
    assert "PartitionFilters: [isnotnull(month" in one._jdf.queryExecution().executedPlan().toString()


def test_json_lines(spark, tmp_path):
    files.write_json(spark.createDataFrame([(1, "a"), (2, None)], "id int, t string"), str(tmp_path / "j"))
    assert {(r.id, r.t) for r in spark.read.json(str(tmp_path / "j")).collect()} == {(1, "a"), (2, None)}


def test_kept(spark):
    df = files.kept(spark.range(10).selectExpr("id AS a"))
    assert df.count() == 10 and df.storageLevel.useMemory and df.storageLevel.useDisk
    df.unpersist()


def test_json_arrays(spark, tmp_path):
    rows = [tuple(post(i)[c] for c in POST.fieldNames()) for i in range(20)]
    files.write_json_arrays(spark.createDataFrame(rows, POST), str(tmp_path / "a"), 3)
    back = files.read_posts_json(spark, str(tmp_path / "a"), array=True)
    assert sorted(r.id for r in back.collect()) == list(range(20))


def test_json_array_files_stay_small_whatever_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ARRAY_BYTES", 4000, raising=False)
    same = spark.range(3000).selectExpr("if(id < 2000, 1, id) AS id", "'a title of some length' AS title")
    files.write_json_arrays(same, str(tmp_path / "a"), 2)
    sizes = [p.stat().st_size for p in (tmp_path / "a").rglob("*.txt")]
    assert len(sizes) > 20 and max(sizes) < 4 * 4000
    back = files.read_posts_json(spark, str(tmp_path / "a"), array=True)
    assert sorted(r.id for r in back.collect()) == [1] * 2000 + list(range(2000, 3000))
    files.write_json_arrays(same.where("false"), str(tmp_path / "none"))


def test_a_file_that_holds_an_array_is_read_once(spark, tmp_path):
    """Numbers wanted as text keep their spelling, and Spark does not go back to the file for each of them."""
    records = ",\n".join(f'{{"id": {i}, "title": "a\\nb {i}", "view_count": {i}.50, "channel": {{"of": 1e5}}}}' for i in range(5000))
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.json").write_text(f"[{records}]")
    (tmp_path / "in/b.json").write_text('[{"id": 9, "title": "cut off')
    read = lambda: sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())
    before = read()
    back = files.read_posts_json(spark, str(tmp_path / "in"), array=True).collect()
    assert read() - before < 8 * (tmp_path / "in/a.json").stat().st_size
    good = sorted((r.id, r.title, r.view_count, r.channel) for r in back if r.id is not None)
    assert good == sorted((i, f"a\nb {i}", f"{i}.50", '{"of": 1e5}') for i in range(5000))
    assert len(back) == 5001


def test_links_in_all_quotings(spark):
    html = (
        '<a data-href="/wrong" href="/right">one</a><A HREF=\'/single?a=1&amp;b=2\'>two &amp; 2</A>'
        '<a class=x href=/bare>three</a><a title="href=/no" href="sub/page">four</a><a name="x">none</a>'
        '<abbr href="/no">no</abbr><a\nhref = "">five</a><a href="//cdn.example.org/x">six</a><a href="#top">seven</a>'
    )
    pages = spark.createDataFrame([(1, "https://h.example/dir/p?q=1", html)], "page_id int, url string, html string")
    rows = page_links(pages, ["page_id"], base="url").orderBy("pos").collect()
    assert [(r.href, r.text) for r in rows] == [
        ("/right", "one"), ("/single?a=1&b=2", "two & 2"), ("/bare", "three"), ("sub/page", "four"), ("", "five"),
        ("//cdn.example.org/x", "six"), ("#top", "seven")]
    assert [r.address for r in rows] == [
        "https://h.example/right", "https://h.example/single?a=1&b=2", "https://h.example/bare",
        "https://h.example/dir/sub/page", "https://h.example/dir/p?q=1", "https://cdn.example.org/x",
        "https://h.example/dir/p?q=1#top"]


def test_links(spark):
    html = """<A class=x HREF="/a?x=1">One &amp; <b>two</b>
      more</A><a name="n">no href</a><a href="">empty</a><abbr href="/no">x</abbr><a href="/l">%s</a>""" % ("y" * 80)
    rows = page_links(spark.createDataFrame([(1, html)], "page_id int, html string"), ["page_id"]).collect()
    assert [(r.pos, r.href, r.text) for r in rows] == [(0, "/a?x=1", "One & two more"), (1, "", "empty"), (2, "/l", "y" * 60)]
