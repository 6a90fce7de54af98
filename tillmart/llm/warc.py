"""Content-addressed WARC archive.

Writing stores every distinct payload once, under its SHA-256, and the exact header block of every
record in a table of its own. Of records with equal payloads of at least ``least`` bytes the one with
the largest page id is the response, the others are revisits that refer to it. Payload bytes are
compressed before they are shuffled or stored; equal payloads are reduced to one per task before the
shuffle. Reading joins headers and payloads to the original records, verifies the strong digest and
the header's digest and length, and parses the header again.

A response's block is an HTTP status line and fields, kept with the record's header, and the payload; a
revisit's block is the HTTP part alone. The payload digest is that of the payload, without the HTTP part. A record's
id comes from its page id, url and payload, so only rows that are equal in all of them share one. Page ids
are extension fields (``X-Page-ID``).

Defined cases: a null payload is empty; a null url is an empty target; null page ids lose against
any other, and a revisit whose response has a null id refers to null. Rows that repeat a page id are
records of their own; those that repeat the response's id and payload are all responses.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.llm.hashing import slices
from tillmart.workspace import Workspace

DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"
_PAYLOADS = "page_id bigint, url string, content_key binary, sha1 string, payload_bytes bigint, packed binary"
RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record binary"


def payloads(pages: DataFrame, payload: str = "html") -> DataFrame:
    """Per page its keys, payload length and packed payload bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3)
        for batch in batches:
            for part in slices(batch):
                raw = [(t or "").encode("utf-8", "surrogatepass") for t in part.column(2).to_pylist()]
                columns = [
                    pa.array([hashlib.sha256(b).digest() for b in raw], pa.binary()),
                    pa.array([base64.b32encode(hashlib.sha1(b).digest()).decode() for b in raw]),
                    pa.array([len(b) for b in raw], pa.int64()),
                    pa.array([pack.compress(b) for b in raw], pa.binary()),
                ]
                names = ["page_id", "url", "content_key", "sha1", "payload_bytes", "packed"]
                yield pa.RecordBatch.from_arrays([*part.columns[:2], *columns], names=names)

    wanted = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col(payload).cast("string"))
    return wanted.mapInArrow(run, _PAYLOADS)


def _record_id() -> F.Column:
    """A record's id: a digest of its page id, url and payload, in the form of a UUID."""
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in (F.col("page_id").cast("string"), F.col("url"))]
    digest = F.md5(F.concat(*parts, F.hex("content_key")))
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *[F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]))


def _http() -> F.Column:
    """The HTTP part of a response's block, with the empty line that ends it."""
    lines = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "]
    return F.concat(F.lit(CRLF.join(lines)), F.col("payload_bytes").cast("string"), F.lit(CRLF * 2))


def _header() -> F.Column:
    """The record's header block as text, with the empty line that ends it."""
    response = F.col("record_type") == "response"
    block = F.octet_length(_http()) + F.when(response, F.col("payload_bytes")).otherwise(F.lit(0))
    page = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("none"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), "record_type"),
        F.concat(F.lit("WARC-Record-ID: <"), "record_id", F.lit(">")),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), "sha1"),
        F.when(~response, F.concat(F.lit("WARC-Refers-To: <"), "response_record", F.lit(">"))),
        F.when(~response, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("X-Page-ID: "), page("page_id")),
        F.when(~response, F.concat(F.lit("X-Refers-To-Page-ID: "), page("refers_to"))),
        F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.concat(F.lit("Content-Length: "), block.cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2))


def write(pages: DataFrame, workspace: Workspace, payload: str = "html", least: int = 0) -> tuple[DataFrame, DataFrame]:
    """The archive's two tables: headers (page_id, record_type, content_key, header and HTTP part of the
    record) and payloads (content_key, packed)."""
    rows = payloads(pages, payload).withColumn("record_id", _record_id())
    # With no least size every payload is shared; smaller ones have an address of their own.
    address = F.when(F.col("payload_bytes") >= least, F.col("content_key"))
    shared = rows.where(address.isNotNull())
    stored = shared.groupBy("content_key").agg(F.max(F.struct("page_id", "record_id")).alias("response"), F.first("packed").alias("packed"))
    workspace.store("payloads", stored)
    table = workspace.spark.read.schema(stored.schema).parquet(workspace.path("payloads"))
    small = rows.where(address.isNull())
    if least > 0:
        lone = small.groupBy("content_key").agg(
            F.lit(None).cast("struct<page_id: bigint, record_id: string>").alias("response"), F.first("packed").alias("packed")
        )
        table = table.unionByName(workspace.store("payloads_small", lone))
    keys = workspace.store("payload_keys", rows.drop("packed"))
    owners = table.where(F.col("response.page_id").isNotNull())
    owners = owners.select("content_key", F.col("response.page_id").alias("response_id"), F.col("response.record_id").alias("response_record"))
    typed = keys.join(owners, "content_key", "left")
    revisit = (F.col("payload_bytes") >= least) & F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    typed = typed.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
    typed = typed.withColumn("refers_to", F.when(revisit, F.col("response_id")))
    headers = typed.select("page_id", "record_type", "content_key", F.encode(F.concat(_header(), _http()), "utf-8").alias("header"))
    return workspace.store("headers", headers), table.select("content_key", "packed")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for part in slices(batch):
            rows = []
            for header, key, packed in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                head, http = header.decode("utf-8", "surrogatepass").split(CRLF * 2, 1)
                fields = dict(line.split(": ", 1) for line in head.split(CRLF)[1:])
                page, refers = (fields.get(f, "none") for f in ("X-Page-ID", "X-Refers-To-Page-ID"))
                body, size, digest = b"", int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"][5:]
                if fields["WARC-Type"] == "response":
                    body = unpack.decompress(packed) if packed is not None else None
                    if body is None or hashlib.sha256(body).digest() != key or len(body) != size:
                        raise ValueError(f"the payload of page {page} is missing or damaged")
                    if base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                        raise ValueError(f"the payload of page {page} has another digest")
                if len(http.encode()) + len(body) != int(fields["Content-Length"]):
                    raise ValueError(f"the header of page {page} tells another length")
                ids = [None if x == "none" else int(x) for x in (page, refers)]
                rows.append((ids[0], size, digest, fields["WARC-Type"], ids[1], header + body + b"\r\n\r\n"))
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
            columns = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record"])


def read(headers: DataFrame, payload_table: DataFrame) -> DataFrame:
    """The archive's records, byte for byte, with their parsed fields. Revisits have no payload and
    stay out of the join, so a payload that many pages share is joined once."""
    responses = headers.where(F.col("record_type") == "response").join(payload_table, "content_key", "left")
    revisits = headers.where(F.col("record_type") == "revisit").withColumn("packed", F.lit(None).cast(T.BinaryType()))
    both = [df.select("header", "content_key", "packed").mapInArrow(_records, RECORD) for df in (responses, revisits)]
    return both[0].unionAll(both[1])


def export(records: DataFrame, folder: str) -> None:
    """Write the records as WARC files. A record ends with two line ends, which is also what Spark's
    text writer puts after every row."""
    body = F.expr("substring(record, 1, length(record) - 4)")
    records.select(F.decode(body, "utf-8").alias("value")).write.option("lineSep", "\r\n\r\n").text(folder)
