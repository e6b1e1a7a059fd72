"""WARC archives as a Spark data source, and de-duplicated archiving of web pages.

Reading plans one partition per file. The requested columns decide what is decoded: where
``payload`` is not among them, a record's block is passed over by its length. Predicates on
header columns are taken from the plan and tested on the parsed header, so a record that
fails them costs its header only. Plain ``.warc`` files keep headers readable and hold
payloads with a content coding of their own; ``.warc.gz`` files, one member per record, are read
as streams, where unwanted blocks are inflated piece by piece and kept nowhere.

Writing gives each task its own files, rolled at a size; a list of the files of a finished write
is put beside them, so files of lost tasks are never read. Paths are URIs that every executor
reaches.

Defined results: a null html is an empty payload; pages without id sort below all others; pages
with one id and one payload are all responses, as none is larger; an empty table gives an
archive without records and an empty result.
"""

from __future__ import annotations

import gzip
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from townhall.session import scratch_path, settle

MIN_REVISIT_BYTES = 1000
FILE_BYTES = 128 << 20
BATCH_BYTES = 4 << 20
_LIST = "_files"

SCHEMA = (
    "record_id string, record_type string, target_uri string, page_id long, payload_bytes long, "
    "payload_digest string, refers_to long, content_length long, payload binary"
)
# column, header name, whether a number
_HEADERS = [
    ("record_id", "WARC-Record-ID", False), ("record_type", "WARC-Type", False),
    ("target_uri", "WARC-Target-URI", False), ("page_id", "X-Page-ID", True),
    ("payload_bytes", "X-Payload-Length", True), ("payload_digest", "WARC-Payload-Digest", False),
    ("refers_to", "X-Refers-To-Page-ID", True), ("content_length", "Content-Length", True),
]
_ARROW = {"payload": pa.binary()} | {c: pa.int64() if number else pa.string() for c, _, number in _HEADERS}


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path.replace("file:///", "file:/", 1).replace("file:/", "file:///", 1))
    return pafs.LocalFileSystem(), path


# -- one record ----------------------------------------------------------------


def _clean(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_bytes(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str,
                 refers_to: int | None) -> bytes:
    """A response record, or a revisit record where ``payload`` is None."""
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}\n{url}\n{digest}")
    kind = "revisit" if payload is None else "response"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if payload is None:
        block = http + b"\r\n"
    else:
        block = http + b"Content-Encoding: gzip\r\n\r\n" + gzip.compress(payload, 1, mtime=0)
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{name}>"), ("WARC-Date", "1970-01-01T00:00:00Z"),
            ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("X-Payload-Length", str(size)), ("Content-Length", str(len(block)))]
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if payload is None:
        head += [("X-Refers-To-Page-ID", str(refers_to)),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _parse_header(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _row(header: dict[str, str]) -> dict:
    row: dict = {}
    for column, name, number in _HEADERS:
        value = header.get(name.lower())
        row[column] = int(value) if number and value is not None else value
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].removeprefix("sha1:").lower()
    return row


def _payload(block: bytes) -> bytes:
    """The body of an HTTP message, decoded."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = _parse_header(head.split(b"\r\n")[1:])
    coding = fields.get("content-encoding", "").lower()
    if coding == "gzip":
        return gzip.decompress(body)
    return zlib.decompress(body) if coding == "deflate" else body


class _Inflated:
    """The members of a .warc.gz file end to end; holds one buffer of inflated bytes."""

    def __init__(self, raw):
        self._file = gzip.GzipFile(fileobj=raw)

    def readline(self) -> bytes:
        return self._file.readline()

    def read(self, size: int) -> bytes:
        return self._file.read(size)

    def skip(self, size: int) -> None:
        while size > 0:
            got = len(self._file.read(min(size, 1 << 16)))
            if not got:
                raise EOFError("the archive ends inside a record")
            size -= got


class _Plain:
    """A seekable file with lines; what is skipped is not read beyond the buffer at hand."""

    def __init__(self, file):
        self._file, self._buffer, self._at = file, b"", 0

    def _fill(self) -> bool:
        more = self._file.read(1 << 16)
        self._buffer = self._buffer[self._at :] + more
        self._at = 0
        return bool(more)

    def readline(self) -> bytes:
        while True:
            end = self._buffer.find(b"\n", self._at)
            if end >= 0:
                line = self._buffer[self._at : end + 1]
                self._at = end + 1
                return line
            if not self._fill():
                line, self._buffer, self._at = self._buffer[self._at :], b"", 0
                return line

    def read(self, size: int) -> bytes:
        while len(self._buffer) - self._at < size and self._fill():
            pass
        out = self._buffer[self._at : self._at + size]
        self._at += len(out)
        return out

    def skip(self, size: int) -> None:
        held = len(self._buffer) - self._at
        if size <= held:
            self._at += size
        else:
            self._file.seek(size - held, 1)
            self._buffer, self._at = b"", 0


def records(source, wanted, with_payload: bool) -> Iterator[dict]:
    """Rows of an archive. ``wanted`` sees the header; only then is a block touched."""
    while True:
        line = source.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        lines = []
        while (line := source.readline()).strip():
            lines.append(line)
        row = _row(_parse_header(lines))
        length = row["content_length"] or 0
        if not wanted(row):
            source.skip(length)
            continue
        if with_payload and row["record_type"] in ("response", "resource"):
            row["payload"] = _payload(source.read(length))
        else:
            source.skip(length)
            row["payload"] = None
        yield row


# -- the data source -----------------------------------------------------------


@dataclass
class _File(InputPartition):
    path: str
    size: int


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


_TESTS = {
    EqualTo: lambda v, x: v == x, GreaterThan: lambda v, x: v > x, GreaterThanOrEqual: lambda v, x: v >= x,
    LessThan: lambda v, x: v < x, LessThanOrEqual: lambda v, x: v <= x, In: lambda v, x: v in x,
}


def _test(f: Filter):
    """A filter on one header column as (column, predicate), or None if it is another kind."""
    column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
    if column not in _ARROW or column == "payload":
        return None
    if isinstance(f, IsNotNull):
        return column, lambda v: v is not None
    if isinstance(f, IsNull):
        return column, lambda v: v is None
    for kind, test in _TESTS.items():
        if type(f) is kind:
            return column, lambda v, test=test, x=f.value: v is not None and test(v, x)
    return None


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self._columns, self._path, self._filters = schema.names, options["path"], []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if _test(f) is None:
                yield f
            else:
                self._filters.append(f)

    def partitions(self) -> list[_File]:
        """The files of a finished write, or every archive of a folder written by something else."""
        system, base = _filesystem(self._path)
        marker = f"{base.rstrip('/')}/{_LIST}"
        if system.get_file_info(marker).type == pafs.FileType.File:
            with system.open_input_stream(marker) as f:
                names = f.read().decode().split()
            found = [system.get_file_info(f"{base.rstrip('/')}/{n}") for n in names]
        elif system.get_file_info(base).type == pafs.FileType.File:
            found = [system.get_file_info(base)]
        else:
            found = system.get_file_info(pafs.FileSelector(base, recursive=True))
        files = [_File(i.path, i.size) for i in found if i.path.endswith((".warc", ".warc.gz")) and i.size]
        # one empty partition where there is no file, as a scan needs one
        return sorted(files, key=lambda f: -f.size) or [_File("", 0)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        tests = [_test(f) for f in self._filters]
        wanted = lambda row: all(test(row[column]) for column, test in tests)
        schema = pa.schema([(c, _ARROW[c]) for c in self._columns])
        system, _ = _filesystem(self._path)
        with system.open_input_file(partition.path) as raw:
            source = _Inflated(raw) if partition.path.endswith(".gz") else _Plain(raw)
            held, size = [], 0
            for row in records(source, wanted, "payload" in self._columns):
                held.append({c: row[c] for c in self._columns})
                size += 200 + len(row["payload"] or b"")
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, schema=schema)


class WarcWriter(DataSourceArrowWriter):
    """Rows page_id, url, payload (null: revisit), payload_bytes, payload_digest, refers_to."""

    def __init__(self, options: dict):
        self._path, self._most = options["path"], int(options.get("filebytes", FILE_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        system, base = _filesystem(self._path)
        system.create_dir(base, recursive=True)
        files: list[str] = []
        out, size = None, 0
        try:
            for batch in iterator:
                for row in zip(*(batch.column(c).to_pylist() for c in
                                 ("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to"))):
                    if out is None or size >= self._most:
                        if out is not None:
                            out.close()
                        files.append(f"part-{uuid.uuid4().hex}.warc")
                        out, size = system.open_output_stream(f"{base.rstrip('/')}/{files[-1]}"), 0
                    data = record_bytes(*row)
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return _Written(files)

    def commit(self, messages: list[_Written | None]) -> None:
        system, base = _filesystem(self._path)
        system.create_dir(base, recursive=True)
        names = [n for m in messages if m is not None for n in m.files]
        with system.open_output_stream(f"{base.rstrip('/')}/{_LIST}") as f:
            f.write("\n".join(names).encode())

    def abort(self, messages: list[_Written | None]) -> None:
        system, base = _filesystem(self._path)
        for m in messages:
            for name in m.files if m is not None else []:
                system.delete_file(f"{base.rstrip('/')}/{name}")


class WarcDataSource(DataSource):
    """``spark.read.format("warc").schema(columns).load(path)``; any subset of the columns, in any order."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        unknown = set(schema.names) - set(_ARROW)
        if unknown:
            raise ValueError(f"no such columns of a WARC record: {sorted(unknown)}")
        return WarcReader(schema, dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Records of a folder or file; only the named columns are parsed (all, if none is named)."""
    register(spark)
    kinds = dict(part.strip().split(" ") for part in SCHEMA.split(","))
    names = columns or tuple(kinds)
    return spark.read.format("warc").schema(", ".join(f"{c} {kinds[c]}" for c in names)).load(path)


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Rows for the writer: of equal payloads of ``min_bytes`` or more the largest page_id holds the bytes."""
    plain = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("payload_digest", F.sha1("payload")).withColumn("payload_bytes", F.length("payload").cast("long"))
    large = plain.where(F.col("payload_bytes") >= min_bytes)
    # digests that occur once are not looked up; the table of the others is written, so that a
    # join can split a payload with many copies
    groups = large.groupBy("payload_digest", "payload_bytes").agg(
        F.max("page_id").alias("holder"), F.count("*").alias("n")
    ).where("n > 1 and holder is not null")
    groups = settle(groups.select("payload_digest", "payload_bytes", "holder"), "payloads")
    joined = plain.join(groups, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("holder").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("holder"))
    return joined.select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "payload_bytes", "payload_digest",
        F.when(revisit, F.col("holder")).alias("refers_to"),
    )


def write_warc(pages: DataFrame, path: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """One record per row of page_id, url, html."""
    register(pages.sparkSession)
    with_revisits(pages, min_bytes).write.format("warc").mode("append").save(path)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages and reads them back, with two reads of the archive.

    Responses are decoded, and their length and digest are those of the bytes read; revisits
    come from their headers, and their blocks are passed over.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages, path)
    responses = read_warc(spark, path, "page_id", "record_type", "payload").where("record_type = 'response'")
    revisits = read_warc(
        spark, path, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    ).where("record_type = 'revisit'")
    return responses.select(
        "page_id", F.length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"),
        "record_type", F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(revisits)
