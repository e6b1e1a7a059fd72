"""Broken files are told apart by record; payloads are kept as VARIANT with columns of their own."""

import glob
import json

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from townhall.schema import CAPTURE
from townhall.sources import files

POSTS = StructType([StructField(c, StringType()) for c in ("id", "title", "n")])


def test_half_a_file_is_broken(spark, tmp_path):
    lines = [json.dumps({"url": f"u{i}", "data": {"items": [i, "é\n"]}}) for i in range(200)]
    broken = [x[: 3 + i % (len(x) - 4)] if i % 2 else x for i, x in enumerate(lines)]
    (tmp_path / "a.json").write_text("\n".join(broken) + "\n\n")
    (tmp_path / "b.json").write_text("\n".join(lines[:10]))
    good, bad = files.read_checked(spark, f"file://{tmp_path}", CAPTURE)
    assert sorted((r.url, json.loads(r.d)["items"][0]) for r in good.select("url", F.to_json("data").alias("d")).collect()) == sorted(
        [(f"u{i}", i) for i in range(0, 200, 2)] + [(f"u{i}", i) for i in range(10)])
    found = bad.collect()
    assert sorted(r.record for r in found) == sorted(broken[1::2])
    assert {r.file.rsplit("/", 1)[1] for r in found} == {"a.json"} and {r.split_start for r in found} == {0}
    assert bad.count() == 100 and good.count() == 110  # alone as well


def test_lines_with_other_numbers_of_fields(spark, tmp_path):
    (tmp_path / "p.csv").write_text('id,title,n\n1,"a, b",3\n2,only\n3,c,4,5\n4,"d ""q""",6\n')
    good, bad = files.read_checked(spark, f"file://{tmp_path}", POSTS, "csv")
    assert [tuple(r) for r in good.orderBy("id").collect()] == [("1", "a, b", "3"), ("4", 'd "q"', "6")]
    assert [r.id for r in good.select("id").orderBy("id").collect()] == ["1", "4"]
    assert sorted(r.record for r in bad.collect()) == ["2,only", "3,c,4,5"]


def test_a_broken_array_file_is_damaged_as_a_whole(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"url": "x", "data": 1}, {"url": ')
    (tmp_path / "b.json").write_text('[{"url": "y", "data": [1]}, {"url": "z", "data": null}]')
    good, bad = files.read_checked(spark, f"file://{tmp_path}", CAPTURE, multiLine=True)
    assert {"y", "z"} <= {r.url for r in good.collect()}
    assert [r.file.rsplit("/", 1)[1] for r in bad.collect()] == ["a.json"]


def test_nothing_is_lost_in_variants(spark, tmp_path):
    texts = ['{"id": 1, "title": "a", "n": {"x": 1.5}}', '{"id": "one", "title": null}', "[1, 2]", '"text"', "null", "{}", None, '{"n": [{"x": 1}]}']
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string").select("k", F.parse_json("text").alias("item"))
    before = [spark.conf.get(key, None) for key in files._SHREDDED]
    files.write_variants(df.coalesce(1), f"file://{tmp_path}/v")
    back = spark.read.parquet(f"file://{tmp_path}/v")
    show = lambda d: sorted((r.k, r.t) for r in d.select("k", F.to_json("item").alias("t")).collect())
    assert [k for k, _ in show(back)] == list(range(8))
    assert [t and json.loads(t) for _, t in show(back)] == [t and json.loads(t) for t in texts]
    assert [spark.conf.get(key, None) for key in files._SHREDDED] == before


def test_a_path_reads_its_own_column(spark, tmp_path):
    body = F.repeat(F.sha2(F.col("id").cast("string"), 512), 8)
    item = F.parse_json(F.to_json(F.struct(F.col("id"), F.lit("t").alias("title"), body.alias("body"))))
    files.write_variants(spark.range(5000).select(item.alias("item")).coalesce(1), f"file://{tmp_path}/v")
    ids = spark.read.parquet(f"file://{tmp_path}/v").select(F.variant_get("item", "$.id", "bigint").alias("id"))
    assert ids.agg(F.sum("id")).first()[0] == 4999 * 2500
    assert "ReadSchema: struct<item:struct<0:bigint>>" in ids._jdf.queryExecution().executedPlan().toString()
    group = pq.ParquetFile(glob.glob(f"{tmp_path}/v/*.parquet")[0]).metadata.row_group(0)
    sizes = {group.column(i).path_in_schema: group.column(i).total_compressed_size for i in range(group.num_columns)}
    own = sum(n for path, n in sizes.items() if ".id." in path or path.endswith((".metadata", "item.value")))
    assert any(".id." in path for path in sizes) and own < sum(sizes.values()) / 10
