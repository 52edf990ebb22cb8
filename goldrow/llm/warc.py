"""WARC archives: written by Spark's text sink, read by a Python data source.

Writing. Each page becomes a ``response`` record, or a ``revisit`` of the page with the
smallest id among those of equal payload. Only digests are grouped; payloads go from the
scan to the sink, joined with the table of revisits alone, which Spark broadcasts while it
is small. Records are UTF-8 text ending in an empty line, so the text sink writes them
unchanged to any file system that Spark knows: one task, one archive.

Reading. ``spark.read.format("warc")`` plans one partition per archive. Equality and IN
filters on header columns, and options named ``header.<name>``, are tested as soon as a
record's headers are parsed; a payload is decoded only if the record passes and the schema
that is read has the column ``payload``, and is sought over otherwise.
"""

from __future__ import annotations

import base64
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull
from pyspark.sql.types import StructType

from goldrow.session import write_through

#: A payload of fewer bytes is stored with each of its pages.
MIN_REVISIT_BYTES = 0
#: Bytes of payload in one Arrow batch of the reader.
BATCH_BYTES = 8 << 20

# The base-32 digits of Spark's conv() and of RFC 4648.
_CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

SCHEMA = (
    "record_type string, record_id string, target_uri string, payload_digest string, "
    "payload_bytes bigint, refers_to string, headers map<string,string>, payload binary"
)
#: Columns that are one header each, and so known before the payload is touched.
_HEADER_OF = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}
_PAGE, _REFERS_TO_PAGE, _LENGTH = "WARC-X-Page-Id", "WARC-X-Refers-To-Page-Id", "WARC-X-Payload-Length"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: 10 hex digits are 40 bits, which are 8 base-32 digits."""
    digest = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)
    ]
    return F.translate(F.concat(*groups), _CONV_DIGITS, _BASE32_DIGITS)


def _with_digest(pages: DataFrame) -> DataFrame:
    html = F.coalesce(F.col("html"), F.lit(""))
    return pages.select("page_id", "url", html.alias("html")).withColumn(
        "digest", base32_sha1(F.col("html").cast("binary"))
    )


def revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Rows (page_id, digest, first) of the pages that repeat the payload of page ``first``.

    ``first`` is the smallest id with that payload. A null id is larger than any other.
    Repeated rows of the smallest id are all responses.
    """
    digests = _with_digest(pages).where(F.octet_length("html") >= min_bytes)
    digests = digests.select("page_id", "digest")
    first = digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    later = F.col("page_id").isNull() | (F.col("page_id") > F.col("first"))
    return (
        digests.join(first.where("n > 1 AND first IS NOT NULL").drop("n"), "digest")
        .where(later)
        .select("page_id", "digest", "first")
        .distinct()
    )


def _record_id(page: Column, digest: Column) -> Column:
    name = F.md5(F.concat_ws("/", page.cast("string"), digest))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_warc(
    pages: DataFrame,
    path: str,
    date: str = "1970-01-01T00:00:00Z",
    min_bytes: int = MIN_REVISIT_BYTES,
) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) below the folder ``path``.

    A null html is an empty payload, a null url an empty one; control characters and spaces
    of a url become ``%20``. An empty table writes archives without records.
    """
    known = write_through(revisits(pages, min_bytes), "revisits").withColumnsRenamed(
        {"page_id": "r_page", "digest": "r_digest"}
    )
    rows = _with_digest(pages)
    same = F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("digest") == F.col("r_digest"))
    rows = rows.join(known, same, "left").withColumn("again", F.col("first").isNotNull())

    def line(name: str, value: Column | str) -> Column:
        text = F.lit(value) if isinstance(value, str) else value.cast("string")
        return F.concat(F.lit(f"{name}: "), text, F.lit("\r\n"))

    size = F.octet_length("html")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        line("Content-Length", size),
        F.lit("\r\n"),
    )
    block = F.concat(http, F.when(F.col("again"), "").otherwise(F.col("html")))
    url = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\x00-\x20\x7f]", "%20")
    optional = [
        F.when(F.col("page_id").isNotNull(), line(_PAGE, F.col("page_id"))),
        F.when(F.col("again"), line("WARC-Profile", _PROFILE)),
        F.when(F.col("again"), line("WARC-Refers-To", _record_id(F.col("first"), F.col("digest")))),
        F.when(F.col("again"), line(_REFERS_TO_PAGE, F.col("first"))),
    ]
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("again"), "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        line("WARC-Date", date),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line(_LENGTH, size),
        *[F.coalesce(o, F.lit("")) for o in optional],
        line("Content-Type", "application/http; msgtype=response"),
        line("Content-Length", F.octet_length(block)),
        F.lit("\r\n"),
        block,
        F.lit("\r\n\r"),  # the sink adds the last line feed
    )
    rows.select(record.alias("value")).write.text(path)


class Archive(InputPartition):
    def __init__(self, path: str | None):
        self.path = path


class WarcDataSource(DataSource):
    """Read WARC files below ``path``. Options: ``verify`` recomputes digests of payloads
    that are read and fails on a mismatch; ``header.<name>`` keeps records whose header has
    that value."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(schema, dict(self.options))


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self.columns = schema.fieldNames()
        self.path = options["path"]
        self.verify = options.get("verify", "false").lower() == "true"
        self.present: list[str] = []
        prefix = "header."
        self.wanted = [
            (k[len(prefix) :].lower(), {v}) for k, v in options.items() if k.startswith(prefix)
        ]

    def pushFilters(self, filters):
        for f in filters:
            known = isinstance(f, EqualTo | In | IsNotNull)
            header = _HEADER_OF.get(f.attribute[0]) if known else None
            if header is None:
                yield f
            elif isinstance(f, IsNotNull):
                self.present.append(header)
            else:
                values = f.value if isinstance(f, In) else [f.value]
                prefix = "sha1:" if f.attribute[0] == "payload_digest" else ""
                self.wanted.append((header, {f"{prefix}{v}" for v in values}))

    def partitions(self) -> list[Archive]:
        fs, root = FileSystem.from_uri(self.path)
        info = fs.get_file_info(root)
        if info.type == FileType.File:
            return [Archive(root)]
        files = fs.get_file_info(FileSelector(root, recursive=True))
        hidden = ("_", ".")
        found = [
            Archive(f.path)
            for f in files
            if f.type == FileType.File and not f.base_name.startswith(hidden) and f.size
        ]
        return found or [Archive(None)]

    def read(self, partition: Archive) -> Iterator[pa.RecordBatch]:
        if partition.path is None:
            return
        fs, _ = FileSystem.from_uri(self.path)
        rows, held = [], 0
        with io.BufferedReader(fs.open_input_file(partition.path), 1 << 20) as stream:
            for row in self._records(stream, partition.path):
                rows.append(row)
                held += 512 + len(row["payload"] or b"")
                if held >= BATCH_BYTES:
                    yield self._batch(rows)
                    rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _records(self, stream: io.BufferedReader, path: str) -> Iterator[dict]:
        with_payload = "payload" in self.columns or self.verify
        while line := stream.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"{path}: no WARC record at byte {stream.tell() - len(line)}")
            headers = _headers(stream)
            length = int(headers["content-length"])
            if any(headers.get(name) not in values for name, values in self.wanted) or any(
                name not in headers for name in self.present
            ):
                stream.seek(length, io.SEEK_CUR)
                continue
            payload = None
            if with_payload and headers.get("warc-type") != "revisit":
                block = stream.read(length)
                if len(block) < length:
                    raise ValueError(f"{path}: the last record is cut short")
                http = headers.get("content-type", "").startswith("application/http")
                payload = block.partition(b"\r\n\r\n")[2] if http else block
            else:
                stream.seek(length, io.SEEK_CUR)
            yield self._row(headers, payload, path)

    def _row(self, headers: dict[str, str], payload: bytes | None, path: str) -> dict:
        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
        if self.verify and payload is not None and digest is not None:
            found = base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()
            if found != digest:
                raise ValueError(f"{path}: payload of {headers.get('warc-record-id')} was changed")
        size = headers.get(_LENGTH.lower())
        row = {column: headers.get(header) for column, header in _HEADER_OF.items()}
        return row | {
            "payload_digest": digest,
            "payload_bytes": len(payload) if payload is not None else size and int(size),
            "headers": list(headers.items()),
            "payload": payload,
        }

    def _batch(self, rows: list[dict]) -> pa.RecordBatch:
        kinds = {
            "payload_bytes": pa.int64(),
            "headers": pa.map_(pa.string(), pa.string()),
            "payload": pa.binary(),
        }
        arrays = [
            pa.array([r[c] for r in rows], kinds.get(c, pa.string())) for c in self.columns
        ]
        return pa.RecordBatch.from_arrays(arrays, names=self.columns)


def _headers(stream: io.BufferedReader) -> dict[str, str]:
    found = {}
    while line := stream.readline().rstrip(b"\r\n"):
        name, _, value = line.partition(b":")
        found[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
    return found


def read_warc(spark: SparkSession, path: str, columns: str = SCHEMA, **options: str) -> DataFrame:
    """Records of the archives below ``path``; leave ``payload`` out of ``columns`` to skip it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    reader = spark.read.format("warc").schema(columns)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def page_columns(records: DataFrame) -> DataFrame:
    """One row per record that came from a page, in the terms of the pages table."""
    headers = F.col("headers")
    return records.select(
        headers[_PAGE.lower()].cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        headers[_REFERS_TO_PAGE.lower()].cast("bigint").alias("refers_to"),
    )
