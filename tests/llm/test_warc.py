"""Archives: exact round trips, revisits, and streamed reading."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from cargolens.llm import warc

SCHEMA = "page_id long, url string, html string"


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def rows_of():
    rng = random.Random(12)
    bodies = [None, "", "a", "é" * 3, "WARC/1.1\r\n\r\n", "x" * 1000, "\r\n" * 70, "\U0001f600\x00" * 40]
    rows = [(i, rng.choice(["http://a/é b", None, "http://x/\r\nWARC-Type: y", "http://y/%20"]), rng.choice(bodies)) for i in range(120)]
    return rows + [(1000 + i, "u", f"own {i} " * rng.randint(1, 90)) for i in range(40)] + [
        (None, "u", "a"), (None, None, "only of null ids"), (None, None, "only of null ids"), (3000, "u", "again"), (3000, "u", "again")]


def expected(rows, min_bytes=0):
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        equal = [j for j, _, h in rows if (h or "").encode() == data and j is not None]
        kept = max(equal) if equal and len(data) >= min_bytes else i
        out.append((i, len(data), digest(data), "response" if i == kept else "revisit", None if i == kept else kept))
    return out


@pytest.mark.parametrize("chunk, min_bytes", [(warc.CHUNK, 0), (7, 0), (64, 5)])
def test_round_trip(spark, tmp_path, chunk, min_bytes):
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("rid", F.lit("clash")).repartition(5)
    manifest = warc.write_warc(df, folder=str(tmp_path / "w"), min_bytes=min_bytes, chunk=chunk)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows)
    read = [(None if r.id is None else int(r.id), r.payload_bytes, r.payload_digest, r.record_type,
             None if r.refers_to is None else int(r.refers_to)) for r in warc.read_records(manifest).collect()]
    # rows that repeat an id and payload: one is the response, the others revisit it
    unique = [r for r in rows if r[0] not in (None, 3000)]
    of = lambda found: sorted(r for r in found if r[0] not in (None, 3000))
    assert of(read) == of(expected([*unique, *[r for r in rows if r[0] in (None, 3000)]], min_bytes))
    assert sorted((r[3], r[4]) for r in read if r[0] == 3000) == [("response", None), ("revisit", 3000)]
    alone = sorted(r[3] for r in read if r[0] is None and r[1] == len("only of null ids"))
    assert alone == ["response", "revisit"]
    # bytes come back exactly, chunk by chunk
    chunks = warc.read_chunks(manifest, chunk).filter("record_type = 'response'").orderBy("record_id", "no").collect()
    whole = {}
    for c in chunks:
        whole[c.record_id] = whole.get(c.record_id, b"") + bytes(c.data)
        assert len(c.data) <= chunk and c.bytes == len(whole[c.record_id]) and c.digest == digest(whole[c.record_id])
    assert set(whole.values()) == {(h or "").encode() for _, _, h in rows}


def test_archives_are_plain_warc(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a/", "same"), (2, "http://b/", "same")], SCHEMA)
    manifest = warc.write_warc(df.coalesce(1), folder=str(tmp_path / "w")).collect()
    text = b"".join(gzip.open(m.file).read() for m in manifest).decode()
    assert text.count("WARC-Type: response\r\n") == 1 and text.count("WARC-Type: revisit\r\n") == 1
    assert "WARC-Refers-To-Target-URI: http://b/\r\n" in text and text.endswith("\r\n\r\n") and text.count("same") == 1
    assert text.count(f"WARC-Payload-Digest: sha1:{digest(b'same')}") == 2


def test_chunk_rows_carry_digests(spark):
    df = spark.createDataFrame([(1, "u", "abcdefgh"), (2, "u", None)], SCHEMA)
    rows = [tuple(r) for r in warc.chunk_rows(df, "page_id", "url", "html", 3).select(
        "id", "no", "last", "data", "bytes", "sha1", "sha256").orderBy("id", "no").collect()]
    parts = [(1, 0, False, b"abc", 3, b"abc"), (1, 1, False, b"def", 6, b"abcdef"), (1, 2, True, b"gh", 8, b"abcdefgh"), (2, 0, True, b"", 0, b"")]
    assert [(a, b, c, bytes(d), e, f, g) for a, b, c, d, e, f, g in rows] == [
        (a, b, c, d, e, digest(f), hashlib.sha256(f).hexdigest()) for a, b, c, d, e, f in parts]


def test_damage_is_found():
    good = (b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Payload-Digest: sha1:" + digest(b"text").encode()
            + b"\r\nContent-Length: 48\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length:       4\r\n\r\ntext\r\n\r\n")
    assert [r["bytes"] for r in warc.records_of(io.BytesIO(good))] == [4]
    for bad in (good.replace(b"text\r", b"next\r"), good[:-8], b"junk\r\n" + good):
        with pytest.raises(ValueError):
            list(warc.records_of(io.BytesIO(bad)))


def test_long_payload_empty_table_and_sql(spark, tmp_path):
    rows = [(1, "u", "é" * 3_000_000), (2, "u", "é" * 3_000_000), (3, "u", "z" * (2 * warc.CHUNK))]
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(str(tmp_path / "pages.parquet"))
    from cargolens.llm import queries
    got = queries.op12_warc(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == expected(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    names = [c[0] for c in con.execute(queries.ORACLE["op12_warc"]).description]
    assert names == got.columns and sorted(con.execute(queries.ORACLE["op12_warc"]).fetchall()) == expected(rows)
    assert warc.read_records(warc.write_warc(df.limit(0))).count() == 0
