"""WARC archives with revisit resolution.

Only headers (id and payload digest) shuffle: grouped by digest they say which record is the original.
Records are then written as WARC 1.1 text, originals as `response` with the payload, the others as
`revisit` with fresh headers that name the original and no payload. Spark's text writer commits the
archives, so a lost executor leaves no half-written file. A reader walks a file by Content-Length.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.scratch import new_path, written
from tidemark.llm.skew import join_groups

#: A file is read into memory whole: at most so many records with payloads of at most so many bytes are in one, 32 MiB
#: and their headers in all; larger payloads have files of their own.
SIZES = ((16 << 10, 2000), (512 << 10, 64), (1 << 31, 1))
#: Groups of equal payloads that may be broadcast.
BROADCAST_GROUPS = 200_000
#: Fixed values of the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
CAPTURED = "1970-01-01T00:00:00Z"

_BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 20 bits, five hexadecimal digits, are four base32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), *_BASE32)


def _record_id(id_: Column) -> Column:
    """A urn:uuid made from the id, so that a revisit can name its original without meeting it."""
    h = F.md5(F.concat(F.lit("tidemark:"), id_.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def resolved(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """Per row: _id, _url, _payload, _bytes, _digest, _original (its id for a revisit, else null).

    Equal payloads of least_bytes or more: the smallest id is the response. The groups with
    more than one row are written once for all who read the result, and broadcast if they are at most BROADCAST_GROUPS; beyond that they are joined by digest, the
    largest ones apart.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("_id"),
        F.col(url_col).alias("_url"),
        payload.alias("_payload"),
        F.octet_length(payload).cast("long").alias("_bytes"),
        base32_sha1(payload.cast("binary")).alias("_digest"),
    )
    groups = (
        rows.where(F.col("_bytes") >= least_bytes)
        .groupBy("_digest")
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
    )
    groups = written(groups, "warc-groups")
    few = groups.count() <= BROADCAST_GROUPS
    joined = rows.join(F.broadcast(groups), "_digest", "left") if few else join_groups(rows, groups, "_digest", "_n", "_id")
    revisit = (F.col("_bytes") >= least_bytes) & ~F.col("_id").eqNullSafe(F.col("_first")) & F.col("_n").isNotNull()
    return joined.withColumn("_original", F.when(revisit, F.col("_first"))).drop("_first", "_n")


def _line(name: str, value: Column) -> Column:
    """A header line; control characters would end it, so they are written as %XX. Nothing for a null."""
    clean = value
    for code in (13, 10):
        clean = F.replace(clean, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n"))).otherwise("")


def records(rows: DataFrame) -> DataFrame:
    """The text of each record, without the two line ends that close it."""
    revisit = F.col("_original").isNotNull()
    head = F.concat(F.lit(HTTP_HEAD + "Content-Length: "), F.col("_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(revisit, head).otherwise(F.concat(head, F.col("_payload")))
    text = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.coalesce(F.col("_id").cast("string"), F.lit("null")))),
        _line("WARC-Date", F.lit(CAPTURED)),
        _line("WARC-Target-URI", F.col("_url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("_original").cast("string")))),
        _line("X-Page-ID", F.col("_id").cast("string")),
        _line("X-Refers-To-Page-ID", F.col("_original").cast("string")),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    return rows.select(text.alias("value"))


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 0,
) -> None:
    """Write one record per row, deduplicated, as files of WARC text in the folder `path`.

    Payloads of like sizes share files (SIZES), in one folder per size. Null payloads are empty; an empty table gives
    an empty archive. Rows that repeat an id and payload are all responses if the id is the
    smallest, else all revisits. A null id is written without X-Page-ID; it is no original unless all ids of
    the group are null, and then none is a revisit. Other columns are not read.
    """
    rows = resolved(pages, id_col, url_col, payload_col, least_bytes)
    low = -1
    for most, per_file in SIZES:
        # A revisit has no payload, so its record is small.
        some = rows.where(F.when(F.col("_original").isNull(), F.col("_bytes")).otherwise(0).between(low + 1, most))
        records(some).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", per_file).text(f"{path}/upto-{most}")
        low = most


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of one file: headers in lower case, and the content block."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].split(b"\r\n")
        if not re.match(rb"WARC/1\.[01]$", lines[0]):
            raise ValueError(f"no record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines[1:])}
        start, n = end + 4, int(headers["content-length"])
        if data[start + n : start + n + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} doesn't end where it says")
        yield headers, data[start : start + n]
        at = start + n + 4


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to (and payload).

    The digest of a response is computed again and must be the one in its header.
    """
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *["payload"] * with_payload]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                out: list[list] = [[] for _ in names]
                for headers, block in parse(value.as_py()):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = int(re.search(rb"(?im)^content-length: *(\d+)", head)[1])
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    if headers["warc-type"] == "response" and (
                        len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest
                    ):
                        raise ValueError(f"{headers['warc-record-id']}: the payload isn't what its header says")
                    page, original = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
                    row = [
                        None if page is None else int(page), headers.get("warc-target-uri"), size, digest,
                        headers["warc-type"], None if original is None else int(original),
                    ]
                    for column, x in zip(out, [*row, *[payload.decode()] * with_payload], strict=True):
                        column.append(x)
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=False)], names=names)

    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true")
        .load(path).select("content")
    )
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return files.mapInArrow(read, schema + (", payload string" if with_payload else ""))


def op3_warc(spark, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path)
    return read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
