"""WARC archives without repeated payloads: revisit records and reading back."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from platelake.session import cut_lineage

MIN_BYTES = 1000
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Written at this time unless the caller names another.
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
# Records of a file at most; rebalanced tasks usually end a file before.
FILE_RECORDS = 200_000

RECORD = ("page_id long, record_type string, record_id string, refers_to_record string, "
          "target_uri string, payload_digest string, payload_bytes long, payload binary")


def _payload(html: str) -> Column:
    return F.coalesce(F.col(html).cast("binary"), F.lit(b""))


def header_table(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """``id``, ``digest`` (SHA-1, hex) and ``bytes`` of each payload."""
    return pages.select(
        F.col(page_id).alias("id"), F.sha1(_payload(html)).alias("digest"),
        F.octet_length(_payload(html)).cast("long").alias("bytes"))


def originals(headers: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Digests that several records share, with the largest id.

    Headers alone are shuffled, and combined before: a payload that makes up a
    third of all pages costs one row per task.
    """
    return (
        headers.where(F.col("bytes") >= min_bytes).groupBy("digest")
        .agg(F.max("id").alias("original"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("original").isNotNull()).drop("n")
    )


def _record_id(page_id: Column, digest: Column) -> Column:
    """The same id whenever the record is written again."""
    h = F.md5(F.concat_ws("|", page_id.cast("string"), digest).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _lines(*named: tuple[str, Column]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat_ws("\r\n", *[F.concat(F.lit(f"{n}: "), v) for n, v in named])


def records(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
    min_bytes: int = MIN_BYTES, date: str = DATE,
) -> DataFrame:
    """``value``: one WARC record per page, as bytes in a string column.

    Of pages with equal payloads of ``min_bytes`` or more the one with the
    largest id is the response, and the others are revisits without payload.
    Rows that repeat the largest id are responses all. Pages without an id are
    revisits if a page with one has their payload, else responses. A null
    payload is empty, a null url has no line, and line ends in a url are
    percent-encoded. Ids are whole numbers.
    """
    first = originals(header_table(pages, page_id, html), min_bytes)
    payload = _payload(html)
    rows = pages.select(
        F.col(page_id).alias("id"), F.col(url).alias("url"), payload.alias("payload"),
        F.sha1(payload).alias("digest"))
    joined = rows.join(first, "digest", "left")
    revisit = F.col("original").isNotNull() & ~F.coalesce(
        F.col("original") == F.col("id"), F.lit(False))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"), F.lit(END))
    block = F.when(revisit, F.lit("")).otherwise(
        F.concat(http, F.col("payload").cast("string")))
    header = _lines(
        ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", _record_id(F.col("id"), F.col("digest"))),
        ("WARC-Date", F.lit(date)),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", digest),
        ("WARC-Refers-To", F.when(revisit, _record_id(F.col("original"), F.col("digest")))),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        ("Content-Type", F.when(~revisit, F.lit("application/http;msgtype=response"))),
        ("X-Page-Id", F.col("id").cast("string")),
        ("Content-Length", F.octet_length("block").cast("string")),
    )
    return joined.withColumn("block", block).select(
        F.concat(F.lit(VERSION + "\r\n"), header, F.lit(END), F.col("block")).alias("value"))


def write_archives(pages: DataFrame, path: str, compression: str = "gzip", **options) -> None:
    """Writes the records as files ``part-*.txt.gz`` of whole records. Spark
    commits them, so a repeated task leaves no second copy."""
    (
        records(pages, **options).write.option("lineSep", END)
        .option("maxRecordsPerFile", FILE_RECORDS)
        .option("compression", compression).text(path)
    )


def _parse(data: bytearray, at: int) -> tuple[dict, int] | None:
    """The record that starts at a place, and where it ends; None if more
    bytes are needed."""
    while data.startswith(b"\r\n", at):
        at += 2
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        return None
    first, *lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a record: {first[:60]!r}")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    body = stop + 4
    end = body + int(fields["content-length"])
    if len(data) < end + 4:
        return None
    block = bytes(data[body:end])
    if fields.get("content-type", "").startswith("application/http"):
        block = block[block.index(b"\r\n\r\n") + 4:]
    return {"fields": fields, "block": block}, end + 4


def _row(record: dict) -> tuple:
    fields, block = record["fields"], record["block"]
    kind = fields.get("warc-type")
    page = fields.get("x-page-id")
    own = kind == "response"
    return (
        int(page) if page is not None else None, kind, fields.get("warc-record-id"),
        fields.get("warc-refers-to"), fields.get("warc-target-uri"),
        hashlib.sha1(block).hexdigest() if own
        else fields.get("warc-payload-digest", "").removeprefix("sha1:"),
        len(block) if own else None, block if own else None)


_TYPES = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(),
          pa.int64(), pa.binary())
_NAMES = [c.split()[0] for c in RECORD.split(", ")]
# Bytes of payload per Arrow batch that goes back to Spark.
_BATCH = 8 << 20


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of one file after another to records, by their Content-Length."""
    data, at, rows, held = bytearray(), 0, [], 0

    def flush() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[] for _ in _TYPES]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)

    for batch in batches:
        for line in batch.column("value"):
            data += line.as_py()
            data += b"\r\n\r\n"
            while (found := _parse(data, at)) is not None:
                record, at = found
                rows.append(_row(record))
                held += len(record["block"]) + 500
            if at > 1 << 16 or at == len(data):
                del data[:at]
                at = 0
            if held > _BATCH:
                yield flush()
                rows, held = [], 0
    if bytes(data[at:]).strip(b"\r\n"):
        raise ValueError("an archive ends within a record")
    if rows:
        yield flush()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives: responses with their payload, its digest
    computed anew and its length; revisits with the digest they declare.

    Files are streamed, so a task holds one record and not one file.
    """
    lines = spark.read.option("lineSep", END).text(path)
    return lines.select(F.col("value").cast("binary")).mapInArrow(_read, RECORD)


def resolve(read: DataFrame) -> DataFrame:
    """Adds ``refers_to``, and the payload length to revisits: each is joined to
    the response it names. A revisit whose response is missing or has another
    digest keeps nulls there. The archives are read once: headers go to a table."""
    read = cut_lineage(read.drop("payload"), "headers")
    responses = read.where(F.col("record_type") == "response")
    # Rows that repeat a response are alike.
    named = responses.select(
        F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"),
        "payload_digest", "payload_bytes").dropDuplicates(["refers_to_record"])
    revisits = read.where(F.col("record_type") == "revisit").drop("payload_bytes")
    resolved = revisits.join(named, ["refers_to_record", "payload_digest"], "left")
    columns = ["page_id", "record_type", "target_uri", "payload_digest", "payload_bytes"]
    return responses.select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(
        resolved.select(*columns, "refers_to"))
