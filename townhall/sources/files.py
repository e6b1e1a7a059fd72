"""Readers and writers for captures and post tables."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from townhall.operators.capture import flatten
from townhall.schema import CAPTURE, CHANNEL_POST, POST, all_strings
from townhall.session import settle

ARRAY_BYTES = 8 << 20  # of records in a file that holds an array, about

# Texts that stand for a missing value in CSV files.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Control characters that no JSON text holds unescaped: a file read "by line" with these is one record.
_NO_LINE = "\x01\x02\x03\x04\x05\x06\x07\x08"

CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


DAMAGED = "_damaged"


def read_checked(spark: SparkSession, path: str, schema: StructType, kind: str = "json", **options) -> tuple[DataFrame, DataFrame]:
    """(rows of ``schema``, damaged records) of JSON or CSV files, for files of which a part may be broken.

    A damaged record (file, split_start, record) is one that is no JSON object of this shape, or a line with more or
    fewer fields than the columns: its text, its file and the byte at which the split that holds it begins. It takes
    no row with it but itself; in a file that holds one JSON array, damage is that of the whole file.
    """
    whole = StructType([*schema.fields, StructField(DAMAGED, StringType())])
    if kind == "csv":  # otherwise lines are judged by the fields that a query asks for
        options = {**CSV_OPTIONS, "columnPruning": False, **options}
    raw = (
        spark.read.schema(whole).options(mode="PERMISSIVE", columnNameOfCorruptRecord=DAMAGED, **options).format(kind).load(path)
    )
    # always true; a query of the damaged records alone is not allowed, so a column is read beside them
    first = F.col(schema.names[0])
    read = first.isNull() | (F.length(first.cast("string")) >= 0)
    good = raw.where(F.col(DAMAGED).isNull() & read).select(*schema.names)
    bad = raw.where(F.col(DAMAGED).isNotNull() & read).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split_start"),
        F.col(DAMAGED).alias("record"))
    return good, bad


def read_posts_json(spark: SparkSession, path: str, array: bool = False, schema: StructType = POST) -> DataFrame:
    """Post records, one per line, or (``array=True``) one JSON array per file.

    A file that holds an array is read by one task, as one record of less than 2 GB; records by line are split. It is
    not read with ``multiLine``: there, Spark goes back to the file for each number that is wanted as text.

    Counts and dates are read as text, so an odd value reaches the coercion
    functions instead of emptying the row.
    """
    reader = spark.read.schema(all_strings(schema))
    raw = (reader.option("lineSep", _NO_LINE) if array else reader).json(path)
    return raw.withColumn("id", F.col("id").try_cast("bigint"))


def read_posts_csv(
    spark: SparkSession, path: str, schema: StructType = CHANNEL_POST, multiline: bool = False
) -> DataFrame:
    """Quoted CSV with a header; the usual texts for "missing" become null.

    Large files are split by line. Pass ``multiline=True`` for files whose quoted fields
    span lines; each such file is then read by one task.
    """
    raw = spark.read.schema(all_strings(schema)).options(**CSV_OPTIONS).option("multiLine", multiline).csv(path)
    known = raw.select(
        *[F.when(~F.col(c).isin(*MISSING_TEXTS), F.col(c)).alias(c) for c in raw.columns]
    )
    return known.withColumn("id", F.col("id").try_cast("bigint"))


def read_captures(spark: SparkSession, path: str, array: bool = False, ordered: bool = True) -> DataFrame:
    """Captures (url, data) with data as VARIANT and, if ``ordered``, their arrival order.

    The order is file path, then position in the file: files are written as the
    capture goes on, and names sort by time. A file that holds one JSON array
    (``array=True``) is read by one task; records by line are split.
    """
    raw = spark.read.schema(CAPTURE).option("multiLine", array).json(path)
    if not ordered:
        return raw
    order = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return raw.select(order.alias("capture_ord"), "url", "data")


def kept(df: DataFrame) -> DataFrame:
    """Keep a typed frame for several reports; partitions that do not fit go to disk."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


# -- writers -----------------------------------------------------------------


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, mode: str = "errorifexists") -> None:
    """Header, fixed column order, quotes doubled."""
    out = df.select(*columns) if columns else df
    out.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_flat_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Nested records as flat CSV over whatever columns there are, name-sorted."""
    write_csv(flatten(df), path, mode=mode)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON record per line."""
    df.write.mode(mode).json(path)


def write_json_arrays(df: DataFrame, path: str, files: int | None = None, mode: str = "errorifexists") -> None:
    """One JSON array per file, rows dealt out over at least ``files`` of them by a hash.

    A file is built in one task, so there are as many as keep each at about ARRAY_BYTES; copies of a
    record are dealt out too. Records are written first, so their size is known and their numbers hold.
    """
    text = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    records = settle(df.select(text.alias("record")).withColumn("nth", F.monotonically_increasing_id()), "records")
    size = records.agg(F.sum(F.octet_length("record").cast("long"))).first()[0] or 0
    part = F.pmod(F.xxhash64("record", "nth"), F.lit(max(files or 1, -(-size // ARRAY_BYTES))))
    rows = records.select("record", part.alias("part"))
    whole = F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]"))
    rows.groupBy("part").agg(whole.alias("value")).write.mode(mode).partitionBy("part").text(path)


def write_raw(df: DataFrame, path: str, payload: str = "item", mode: str = "errorifexists") -> None:
    """Untouched records as Parquet, the payload as JSON text."""
    df.withColumn(payload, F.to_json(F.col(payload))).write.mode(mode).parquet(path)


def read_raw(spark: SparkSession, path: str, payload: str = "item") -> DataFrame:
    return spark.read.parquet(path).withColumn(payload, F.parse_json(payload))


# settings under which a VARIANT is written with the fields that most records share in columns of their own
_SHREDDED = {"spark.sql.variant.writeShredding.enabled": "true", "spark.sql.variant.inferShreddingSchema": "true"}


def write_variants(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Untouched records as Parquet, payloads as VARIANT: a read of a path reads that path's column alone.

    Which fields get columns is found from the first rows of every file; records of another shape keep theirs in a
    rest, so nothing is lost. ``spark.read.parquet`` reads it back.
    """
    conf = df.sparkSession.conf
    before = {key: conf.get(key, None) for key in _SHREDDED}
    try:
        for key, value in _SHREDDED.items():
            conf.set(key, value)
        df.write.mode(mode).parquet(path)
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def write_posts(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Typed posts by month, so a month filter reads only its own files."""
    df.write.mode(mode).partitionBy("month").parquet(path)
