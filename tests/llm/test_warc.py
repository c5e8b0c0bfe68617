"""Archives written and read back, against a plain grouping of the rows."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from tristrata.llm import warc
from tristrata.llm.queries import QUERIES
from tristrata.llm.storage import stored

DDL = "page_id long, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, least=0):
    """Of equal payloads the greatest id is the response, once; others revisit it."""
    groups = {}
    for page, url, html in rows:
        groups.setdefault(html or "", []).append((page, url))
    out = []
    for html, members in groups.items():
        size = len(html.encode())
        members.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1] is not None, m[1] or ""))
        lead = members.pop()
        out.append((lead[0], size, digest(html), "response", None))
        for page, _ in members:
            kind = ("revisit", lead[0]) if size >= least else ("response", None)
            out.append((page, size, digest(html), *kind))
    return sorted(out, key=repr)


def resolved(spark, frame, path=None, **options):
    archives = warc.write_archives(frame, path, **options)
    records = stored(warc.read_archives(spark, archives), "records")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    found = warc.with_originals(records).select(columns).collect()
    return sorted((tuple(r) for r in found), key=repr), records


def test_query_over_the_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = QUERIES["op12_warc"](spark, sf_dir)
    table = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    rows = sorted((tuple(r) for r in got.select(columns).collect()), key=repr)
    assert rows == brute([(r.page_id, r.url, r.html) for r in table])


TRICKY = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
ODD = [
    (1, "http://a/", "<p>one</p>"),
    (2, "http://b/", "<p>one</p>"),
    (3, "http://c/", None),
    (4, "http://d/", ""),
    (None, "http://e/", ""),
    (5, None, "<p>two</p>"),
    (5, None, "<p>two</p>"),
    (5, "http://f/", "<p>two</p>"),
    (6, "http://g/\r\nX: y", TRICKY),
    (7, "http://h/", TRICKY + "\r\n\r\n"),
    (8, "http://i/", "ähnlich 中文 🌊\r\n\r\n"),
    (9, "http://j/", "long " * 400_000),
    (10, "http://k/", "long " * 400_000),
    (None, None, None),
    (None, None, None),
    (-4, "http://l/", "\x00\x01"),
]


@pytest.mark.parametrize("least", [0, 1, 11])
def test_odd_rows(spark, least):
    frame = spark.createDataFrame(ODD, DDL).repartition(5)
    rows, records = resolved(spark, frame, least=least, compression="gzip" if least else "none")
    assert rows == brute(ODD, least)
    bodies = {r.payload_digest: r.payload for r in records.where("payload is not null").collect()}
    assert bodies == {digest(h): (h or "").encode() for _, _, h in ODD}
    responses = records.where("record_type = 'response'")
    assert records.select("record_id").distinct().count() == len(ODD)
    assert least or responses.count() == len({h or "" for _, _, h in ODD})


def test_one_payload_has_most_rows_and_one_row_occurs_often(spark, monkeypatch):
    monkeypatch.setattr(warc, "PIECE", 7)
    monkeypatch.setattr(warc, "FILE_BYTES", 9000)
    rows = [(k, f"http://s/{k}", "same" if k % 3 else f"page {k}") for k in range(900)]
    rows += [(5000, "http://s/often", "often")] * 100 + [(5001, "http://s/often", "often")]
    rows += [(77, "http://s/lead", "lead")] * 50
    got, records = resolved(spark, spark.createDataFrame(rows, DDL).repartition(6))
    assert got == brute(rows)
    assert records.select("record_id").distinct().count() == len(rows)
    sizes = records.groupBy("file").agg(F.max("at").alias("at")).collect()
    assert len(sizes) > 10 and all(r["at"] < 60_000 for r in sizes)


def test_records_follow_the_format(spark, tmp_path):
    path = str(tmp_path / "archive")
    frame = spark.createDataFrame(ODD[:2], DDL)
    warc.write_archives(frame, path, date="2024-02-03T04:05:06Z")
    data = b"".join(p.read_bytes() for p in (tmp_path / "archive").glob("*.txt"))
    found = {f["WARC-Type"]: (f, bytes(block)) for _, f, block in warc.parsed(data)}
    response, block = found["response"]
    assert response["WARC-Date"] == "2024-02-03T04:05:06Z" and response["Page-ID"] == "2"
    assert response["WARC-Payload-Digest"] == "sha1:" + digest("<p>one</p>")
    block_digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    assert response["WARC-Block-Digest"] == "sha1:" + block_digest
    assert block.startswith(b"HTTP/1.1 200 OK\r\n") and block.endswith(b"\r\n\r\n<p>one</p>")
    revisit, head = found["revisit"]
    assert revisit["WARC-Refers-To"] == response["WARC-Record-ID"]
    assert revisit["WARC-Refers-To-Target-URI"] == "http://b/"
    assert revisit["WARC-Profile"] == warc.PROFILE and head.endswith(b"\r\n\r\n")
    again = str(tmp_path / "again")
    warc.write_archives(frame, again, date="2024-02-03T04:05:06Z")
    assert sorted(data) == sorted(b"".join(p.read_bytes() for p in (tmp_path / "again").glob("*.txt")))


def test_broken_archives_raise_and_lost_originals_stay_null(spark, tmp_path):
    with pytest.raises(ValueError):
        list(warc.parsed(b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n"))
    with pytest.raises(ValueError):
        list(warc.parsed(b"HTTP/1.1 200 OK\r\n\r\n"))
    with pytest.raises(ValueError):
        warc.write_archives(spark.createDataFrame(ODD, DDL), date="yesterday")
    with pytest.raises(ValueError):
        warc.write_archives(spark.createDataFrame(ODD, DDL), compression="zip")
    _, records = resolved(spark, spark.createDataFrame(ODD[:2], DDL))
    alone = warc.with_originals(records.where("record_type = 'revisit'")).collect()
    assert [(r.page_id, r.refers_to) for r in alone] == [(1, None)]


def test_empty_tables_and_clashing_names(spark):
    frame = spark.createDataFrame(ODD, DDL)
    assert resolved(spark, frame.limit(0))[0] == []
    names = ("id", "digest", "check", "size", "payload", "n", "kind", "uid", "key", "a.b", "first")
    clashing = frame.withColumns({c: F.lit(f"own {c}") for c in names})
    assert resolved(spark, clashing)[0] == brute(ODD)
