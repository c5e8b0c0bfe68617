"""WARC archives in which a payload is stored once and later records revisit it.

Writing shuffles headers, not pages: of the records with equal payloads the one with the greatest
id is the response, the greatest address deciding between equal ids, and each other one becomes a
revisit record that names it. Payloads travel once for each distinct one: a map task keeps one of
its equal payloads before the shuffle. Where one payload belongs to a large part of the rows
its single response goes to where the revisits are.

All headers are made anew: ids are UUIDs by the digest of a record, so a repeated task writes the
same bytes; block and payload lengths and digests are those of what is written; one date is given
to all. Spark's text writer makes the archives, plain or each file compressed as a whole: a record
is a line, whose end is the two line breaks that end a record. A record begins where the length of the one
before says, so a file is read by one task; ``FILE_BYTES`` bounds it by
the mean payload, and a record is never cut.

Null payloads are empty ones. Payloads of fewer than ``least`` bytes are all responses. Null ids
come before all others; a null id or address is left out of the headers and read back as null.
Line breaks in an address are percent-encoded. A row that occurs several times has a record
for each. An empty table gives no records. Pages should be a stored table.
"""

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.llm.storage import shared_path, stored
from tristrata.operators.join import skewed_join

#: Bytes of an archive file, about.
FILE_BYTES = 16 << 20
#: Copies of one header that one row stands for, before they are dealt to tasks.
PIECE = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
CRLF = "\r\n"
GZIP = b"\x1f\x8b"

RECORD = (
    "file string, at long, record_type string, record_id string, refers_to_id string, "
    "page_id long, url string, payload_digest string, payload_bytes long, payload binary"
)


def base32_sha1(text: Column) -> Column:
    """SHA-1 of the UTF-8 bytes in upper-case base 32: five bytes are eight digits."""
    digest = F.sha1(text)
    parts = (
        F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)
    )
    ours, theirs = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return F.translate(F.concat(*parts), ours, theirs)


def keyed(pages: DataFrame, page_id: str, url: str, payload: str) -> DataFrame:
    """Rows ``id, url, digest, check, size, payload``; ``check`` tells payloads of one SHA-1."""
    whole = F.coalesce(F.col(f"`{payload}`"), F.lit(""))
    address = F.replace(F.col(f"`{url}`"), F.lit("\r"), F.lit("%0D"))
    return pages.select(
        F.col(f"`{page_id}`").cast("long").alias("id"),
        F.replace(address, F.lit("\n"), F.lit("%0A")).alias("url"),
        base32_sha1(whole).alias("digest"),
        F.xxhash64(whole).alias("check"),
        F.octet_length(whole).cast("long").alias("size"),
        whole.alias("payload"),
    )


KEY = ["digest", "check"]


def uid_of(copy: Column) -> Column:
    """A UUID by the digest of a header and the number of its copy."""
    values = ("digest", "check", "id", "url")
    text = F.concat_ws(
        "\t", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in values), copy.cast("string")
    )
    digits = F.md5(text)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *(F.substring(digits, a, n) for a, n in cuts))


def copies(heads: DataFrame) -> DataFrame:
    """A row for each of the ``n`` copies of a header from ``first`` on, numbered by ``copy``."""
    turns = F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)
    few = heads.where(F.col("n").between(1, PIECE)).withColumn("copy", F.explode(turns))
    many = heads.where(F.col("n") > PIECE)
    step = F.sequence(F.col("first"), F.col("first") + F.col("n") - 1, F.lit(PIECE).cast("long"))
    upto = F.least(F.lit(PIECE - 1).cast("long") + F.col("piece"), F.col("first") + F.col("n") - 1)
    pieces = many.withColumn("piece", F.explode(step)).repartition("digest", "id", "url", "piece")
    dealt = pieces.withColumn("copy", F.explode(F.sequence("piece", upto))).drop("piece")
    return few.unionByName(dealt).drop("n", "first")


def resolved(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    *,
    least: int = 0,
) -> DataFrame:
    """A row for each record: ``id, url, digest, size, uid, kind`` and ``payload`` or the ``refers_``
    to id, uid and address of the response that it revisits."""
    rows = keyed(pages, page_id, url, payload)
    bare, text = F.lit(None).cast("long"), F.lit(None).cast("string")
    none = {"refers_id": bare, "refers_uid": text, "refers_url": text}
    long = rows.where(F.col("size") >= least) if least > 0 else rows
    heads = stored(
        long.groupBy("id", "url", *KEY, "size").agg(F.count(F.lit(1)).alias("n")), "warc-heads"
    )
    greatest = F.max(F.struct("id", "url")).alias("best")
    groups = heads.groupBy(*KEY).agg(greatest, F.sum("n").alias("rows"))
    leads = groups.select(*KEY, F.col("best.id").alias("id"), F.col("best.url").alias("url"), "rows")
    leads = leads.withColumn("uid", uid_of(F.lit(0)))

    # grouped by what they are joined by, so that payloads are shuffled once
    body = [F.first("size").alias("size"), F.first("payload").alias("payload")]
    bodies = long.groupBy(*KEY).agg(*body)
    responses = (
        leads.join(bodies, KEY)
        .select("id", "url", "digest", "size", "uid", F.lit("response").alias("kind"), "payload")
        .withColumns(none)
    )

    shared = leads.where("rows > 1").select(
        F.concat_ws(":", *KEY).alias("key"),
        F.col("id").alias("refers_id"),
        F.col("uid").alias("refers_uid"),
        F.col("url").alias("refers_url"),
    )
    keyed_heads = heads.withColumn("key", F.concat_ws(":", *KEY))
    named = skewed_join(keyed_heads, shared, "key")
    lead = F.col("id").eqNullSafe(F.col("refers_id")) & F.col("url").eqNullSafe(F.col("refers_url"))
    first = F.when(lead, 1).otherwise(0).cast("long")  # copy 0 of the lead is the response
    named = named.withColumn("first", first).withColumn("n", F.col("n") - F.col("first"))
    revisits = copies(named).withColumn("uid", uid_of(F.col("copy"))).select(
        "id", "url", "digest", "size", "uid", F.lit("revisit").alias("kind"), text.alias("payload"), *none
    )
    records = responses.unionByName(revisits)
    if least > 0:
        small = rows.where(F.col("size") < least)
        small = small.groupBy(*small.columns).agg(F.count(F.lit(1)).alias("n"))
        small = copies(small.withColumn("first", F.lit(0).cast("long")))
        small = small.withColumns({"uid": uid_of(F.col("copy")), "kind": F.lit("response"), **none})
        records = records.unionByName(small.select(*records.columns))
    return records


def record_text(date: str) -> Column:
    """A record of :func:`resolved` as the text of its headers and its block."""

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))

    def urn(column: str) -> Column:
        return F.concat(F.lit("<urn:uuid:"), F.col(column), F.lit(">"))

    http = F.concat(F.lit(HTTP), F.col("size").cast("string"), F.lit(CRLF + CRLF))
    block = F.concat(http, F.coalesce("payload", F.lit("")))
    profile = F.when(F.col("kind") == "revisit", F.lit(PROFILE))
    return F.concat(
        F.lit(VERSION.decode()),
        field("WARC-Type", F.col("kind")),
        field("WARC-Record-ID", urn("uid")),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        field("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32_sha1(block))),
        field("WARC-Profile", profile),
        field("WARC-Refers-To", urn("refers_uid")),
        field("WARC-Refers-To-Target-URI", F.col("refers_url")),
        field("Page-ID", F.col("id").cast("string")),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF),
        block,
    )


def write_archives(
    pages: DataFrame,
    path: str | None = None,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    *,
    least: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    compression: str = "none",
) -> str:
    """Write a record for each row of ``pages`` and return the folder of the archives.

    ``date`` is the capture date of all records, as ``2024-01-31T00:00:00Z``, and ``compression`` of
    the files is ``none`` or ``gzip``.
    """
    if compression not in ("none", "gzip"):
        raise ValueError(f"compression is 'none' or 'gzip', got {compression!r}")
    if not re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,9})?Z", date):
        raise ValueError(f"date must look like 2024-01-31T00:00:00Z, got {date!r}")
    path = path or shared_path(pages.sparkSession, "warc")
    whole = F.octet_length(F.coalesce(F.col(f"`{payload}`"), F.lit("")))
    mean = pages.agg(F.avg(whole)).first()[0] or 0
    records = resolved(pages, page_id, url, payload, least=least).select(
        record_text(date).alias("value")
    )
    each = max(1, int(FILE_BYTES // (mean + 700)))
    options = {"lineSep": END.decode(), "maxRecordsPerFile": each, "compression": compression}
    records.write.options(**options).text(path)
    return path


def parsed(data: bytes) -> Iterator[tuple[int, dict[str, str], memoryview]]:
    """Place, headers and block of each record; raises where a record is broken."""
    at, view = 0, memoryview(data)
    while at < len(data):
        stop = data.find(END, at)
        if not data.startswith(VERSION, at) or stop < 0:
            raise ValueError(f"no WARC record at byte {at}")
        lines = data[at + len(VERSION) : stop].decode().split(CRLF)
        fields = dict(line.split(": ", 1) for line in lines)
        begin = stop + len(END)
        end = begin + int(fields["Content-Length"])
        if data[end : end + len(END)] != END:
            raise ValueError(f"the record at byte {at} does not end where its length says")
        yield at, fields, view[begin:end]
        at = end + len(END)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of all archives below ``path``, rows of ``RECORD``.

    Length and digest of a response are those of its block as read, and must agree with its
    headers; those of a revisit are what its headers say of the payload it stands for.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content"), strict=True):
                name, out = file.as_py(), []
                size = 0
                data = content.as_py()
                data = gzip.decompress(data) if data.startswith(GZIP) else data
                for at, fields, block in parsed(data):
                    out.append(record(name, at, fields, block, payload))
                    size += len(block)
                    if size > 4 << 20 or len(out) >= 10_000:
                        yield pa.RecordBatch.from_pylist(out, schema=SCHEMA)
                        out, size = [], 0
                yield pa.RecordBatch.from_pylist(out, schema=SCHEMA)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(records, RECORD)


SCHEMA = pa.schema(
    [
        ("file", pa.string()),
        ("at", pa.int64()),
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("refers_to_id", pa.string()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_digest", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def record(name: str, at: int, fields: dict, block: memoryview, payload: bool) -> dict:
    head = bytes(block[: bytes(block[:4096]).find(END)])
    body = block[len(head) + len(END) :]
    size = int(re.search(rb"Content-Length: (\d+)", head)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    response = fields["WARC-Type"] == "response"
    if response:
        found = base64.b32encode(hashlib.sha1(body).digest()).decode()
        if (found, len(body)) != (digest, size):
            raise ValueError(f"the payload at byte {at} of {name} is not that of its headers")
    refers = fields.get("WARC-Refers-To")
    page = fields.get("Page-ID")
    return {
        "file": name,
        "at": at,
        "record_type": fields["WARC-Type"],
        "record_id": fields["WARC-Record-ID"],
        "refers_to_id": refers,
        "page_id": None if page is None else int(page),
        "url": fields.get("WARC-Target-URI"),
        "payload_digest": digest,
        "payload_bytes": size,
        "payload": bytes(body) if payload and response else None,
    }


def with_originals(records: DataFrame) -> DataFrame:
    """``records``, stored, with ``refers_to``: the ``page_id`` of the response that each revisits.

    A revisit whose response is not among the records keeps a null there.
    """
    revisits = records.where("record_type = 'revisit'")
    responses = records.where("record_type = 'response'")
    originals = responses.select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")
    )
    found = skewed_join(revisits, originals, "refers_to_id", how="left")
    whole = responses.withColumn("refers_to", F.lit(None).cast("long"))
    return whole.unionByName(found)


def resolved_sql(table: str = "pages", least: int = 0) -> str:
    """What is read back for each row of ``table``, as DuckDB SQL."""
    digits = " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((v{k} >> {5 * (7 - i)}) & 31 AS INTEGER), 1)"
        for k in range(4)
        for i in range(8)
    )
    cuts = ", ".join(
        f"CAST('0x' || substr(digest, {1 + 10 * k}, 10) AS BIGINT) AS v{k}" for k in range(4)
    )
    return f"""
WITH whole AS (SELECT page_id, url, coalesce(html, '') AS body FROM {table}),
hashed AS (SELECT page_id, url, body, strlen(body) AS size, sha1(body) AS digest FROM whole),
cut AS (SELECT *, {cuts} FROM hashed),
ranked AS (
  SELECT page_id, size, {digits} AS payload_digest,
         row_number() OVER same AS turn, first_value(page_id) OVER same AS lead
  FROM cut
  WINDOW same AS (
    PARTITION BY body ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST
  )
)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN turn = 1 OR size < {least} THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN turn > 1 AND size >= {least} THEN lead END AS refers_to
FROM ranked
"""
