"""WARC archives through a table of chunks.

Writing:

1. A payload becomes rows of (record, chunk number, data) of at most ``CHUNK``
   bytes.  Each row carries the digests of the payload up to its end, computed
   incrementally as the rows stream by, so the last one of a record has those of
   the whole payload and no Python worker ever holds one.  The table is written.
2. Of records with equal payloads (SHA-256 and length; counted and compared with
   aggregates that combine before their shuffle) the one with the largest id
   stays a response, the others become revisits that refer to it.
3. A head row for each record (chunk number -1) and its chunks are dealt out by
   record and sorted; each task streams them into gzipped archives, a member for
   each record, and starts another archive at ``ARCHIVE`` bytes.  Archives have
   names of their own for each attempt of a task; the manifest, a table that
   Spark commits, lists those that count.

Reading: a task streams an archive and gives the same kind of chunk rows;
lengths and digests of the bytes read are held against the record's headers,
and a difference is an error.  A revisit's payload is that of its response.

Defined results: a null payload is empty, a null URI has no header field; null
ids are smaller than all others; of rows that repeat an id and payload one is
the response; payloads shorter than ``min_bytes`` are all responses; an empty
table gives no archive and no rows.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import checkpoint_dir
from .common import prepare_long, shared_table

CHUNK = 1 << 20                   # bytes of a chunk
ARCHIVE = 1 << 30                 # compressed bytes after which a task starts another archive
PARTITION = 64 << 20              # payload bytes that a task should write
LEVEL = 4                         # of gzip
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_FIELD = "Row-ID"               # header field of this library: the id of the row


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunk_rows(df: DataFrame, id_col: str, url_col: str, payload_col: str, chunk: int = CHUNK) -> DataFrame:
    """(rid, id, url, no, last, data, bytes, sha1, sha256): the chunks of each payload; bytes and digests are those up to
    the end of the chunk.  (rid numbers the rows of one run: write the table before it is used twice.)"""
    prepare_long(df.sparkSession)
    payload = F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit(b""))
    rows = df.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{id_col}`").alias("id"),
                     F.col(f"`{url_col}`").cast("string").alias("url"), payload.alias("_p"))
    rows = rows.withColumn("_n", F.greatest(F.lit(1), F.ceil(F.octet_length("_p") / chunk)).cast("int"))
    parts = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda k: F.struct(
        k.alias("no"), (k == F.col("_n") - 1).alias("last"), F.substring(F.col("_p"), k * chunk + 1, F.lit(chunk)).alias("data")))
    cut = rows.select("rid", "id", "url", F.explode(parts).alias("e")).select("rid", "id", "url", "e.*")
    schema = StructType(list(cut.schema)).add("bytes", "long").add("sha1", "string").add("sha256", "string")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha1 = sha256 = None
        size = 0
        for b in batches:
            sizes, ones, twos = [], [], []
            for no, data in zip(b.column("no").to_pylist(), b.column("data")):
                if no == 0:                             # a record's chunks come one after another
                    sha1, sha256, size = hashlib.sha1(), hashlib.sha256(), 0
                piece = data.as_buffer()
                sha1.update(piece)
                sha256.update(piece)
                size += len(piece)
                sizes.append(size)
                ones.append(base32(sha1.digest()))      # digest() leaves the running state as it is
                twos.append(sha256.hexdigest())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(sizes, pa.int64()), pa.array(ones, pa.string()),
                                              pa.array(twos, pa.string())], schema.names)

    return cut.mapInArrow(digests, schema)


def decide(chunks: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(rid, id, url, bytes, sha1, refers_rid, refers_url): one row per record, with the response of a revisit."""
    heads = chunks.filter("last").select("rid", "id", "url", "bytes", "sha1", "sha256")
    same = (heads.filter(F.col("bytes") >= min_bytes).groupBy(F.col("sha256").alias("_sha256"), F.col("bytes").alias("_bytes"))
            .agg(F.max(F.struct("id", "rid", "url")).alias("_to"), F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > 1).drop("_n"))
    same = shared_table(same, "repeated_payloads")      # one row a payload: a hot payload's records can be split
    joined = heads.join(same, (F.col("sha256") == F.col("_sha256")) & (F.col("bytes") == F.col("_bytes")), "left")
    revisit = F.col("_to.rid") != F.col("rid")
    return joined.select("rid", "id", "url", "bytes", "sha1", F.when(revisit, F.col("_to.rid")).alias("refers_rid"),
                         F.when(revisit, F.col("_to.url")).alias("refers_url"))


def _storage(folder: str):
    """The file system and path of a folder that all executors share."""
    from pyarrow import fs
    if urlsplit(folder).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlsplit(folder).path
    return fs.FileSystem.from_uri(folder)


def _uri(url: str | None) -> str | None:
    return None if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")


class _Archive:
    """Streams records into one archive."""

    def __init__(self, storage, path: str, date: str):
        self.path, self.date, self.records, self.member = path, date, 0, None
        self.out = storage.open_output_stream(path, compression=None)
        body = b"software: cargolens\r\nformat: WARC File Format 1.1\r\n"
        self._open({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "Content-Type": "application/warc-fields",
                    "Content-Length": str(len(body))})
        self.write(body)
        self.end()
        self.records = 0

    def _open(self, fields: dict[str, str | None]) -> None:
        self.member = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)       # a gzip member for each record
        fields = {"WARC-Date": self.date, **fields}
        lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in fields.items() if v is not None]]
        self.write(("\r\n".join(lines) + "\r\n\r\n").encode())

    def begin(self, fields: dict[str, str | None], payload_bytes: int, with_payload: bool) -> None:
        """Headers of the record and of the stored HTTP answer; the payload's chunks follow."""
        answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()
        self._open({**fields, "Content-Type": "application/http; msgtype=response",
                    "Content-Length": str(len(answer) + (payload_bytes if with_payload else 0))})
        self.write(answer)

    def write(self, data) -> None:
        self.out.write(self.member.compress(data))

    def end(self) -> None:
        self.write(b"\r\n\r\n")
        self.out.write(self.member.flush())
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        size = self.out.tell()
        self.out.close()
        return self.path, self.records, size


def write_archives(chunks: DataFrame, decided: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the records to archives in ``folder``; the manifest: (file, records, bytes)."""
    run = uuid.uuid4()                                   # names the records of this run
    total = decided.agg(F.sum("bytes")).first()[0] or 0
    spark = chunks.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // PARTITION))
    head = decided.select("rid", F.lit(-1).alias("no"), F.lit(None).cast("binary").alias("data"), F.lit(False).alias("last"),
                          F.col("id").cast("string").alias("id"), "url", "bytes", "sha1", "refers_rid", "refers_url")
    body = chunks.select("rid", "no", "data", "last", *[F.lit(None).cast(t).alias(c) for c, t in (
        ("id", "string"), ("url", "string"), ("bytes", "long"), ("sha1", "string"), ("refers_rid", "long"), ("refers_url", "string"))])
    # a number of partitions that is given is kept, so that a record is never split
    rows = head.unionByName(body).repartition(int(tasks), "rid").sortWithinPartitions("rid", "no")

    def name_of(rid: int) -> str:
        return f"<urn:uuid:{uuid.uuid5(run, str(rid))}>"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        storage, root = _storage(folder)
        storage.create_dir(root, recursive=True)
        archive, is_response, closed = None, False, []
        for b in batches:
            data = b.column("data")
            last = b.column("last").to_pylist()
            heads = b.drop_columns(["data", "last"]).to_pylist()
            for i, r in enumerate(heads):
                if r["no"] < 0:
                    if archive is not None and archive.out.tell() >= ARCHIVE:
                        closed.append(archive.close())
                        archive = None
                    archive = archive or _Archive(storage, f"{root}/{uuid.uuid4().hex}.warc.gz", date)
                    is_response = r["refers_rid"] is None
                    archive.begin({
                        "WARC-Type": "response" if is_response else "revisit", "WARC-Record-ID": name_of(r["rid"]),
                        "WARC-Target-URI": _uri(r["url"]), "WARC-Payload-Digest": f"sha1:{r['sha1']}",
                        "WARC-Profile": None if is_response else PROFILE,
                        "WARC-Refers-To": None if is_response else name_of(r["refers_rid"]),
                        "WARC-Refers-To-Target-URI": None if is_response else _uri(r["refers_url"]),
                        ID_FIELD: r["id"] and quote(r["id"], safe="")}, r["bytes"], is_response)
                    continue
                if is_response:
                    archive.write(data[i].as_buffer())
                if last[i]:
                    archive.end()
        if archive is not None:
            closed.append(archive.close())
        yield pa.RecordBatch.from_pylist([dict(zip(("file", "records", "bytes"), c)) for c in closed],
                                         pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return shared_table(rows.mapInArrow(write, "file string, records long, bytes long"), "manifest")


def write_warc(df: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               folder: str | None = None, min_bytes: int = 0, chunk: int = CHUNK) -> DataFrame:
    """Write a record for each row to archives in ``folder`` (default: a new one in the shared folder); the manifest."""
    folder = folder or f"{checkpoint_dir(df.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    chunks = shared_table(chunk_rows(df, id_col, url_col, payload_col, chunk), "payload_chunks")
    return write_archives(chunks, shared_table(decide(chunks, min_bytes), "records"), folder)


def _fields(stream) -> tuple[dict[str, str], int]:
    """Header lines up to the empty one, by lower-case name, and how many bytes they take."""
    fields, size = {}, 0
    while True:
        line = stream.readline()
        size += len(line)
        if not line.strip():
            return fields, size
        name, _, value = line.decode().partition(":")
        fields[name.strip().lower()] = value.strip()


def records_of(stream, chunk: int = CHUNK, with_data: bool = False) -> Iterator[dict]:
    """Chunk rows of the records of one archive, read from front to back."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the beginning of a record: {line[:80]!r}")
        fields, _ = _fields(stream)
        left = int(fields["content-length"])
        if fields["warc-type"] not in ("response", "revisit"):
            while left:
                left -= len(stream.read(min(left, chunk))) or left
            continue
        answer, size = _fields(stream)                   # its first line, the status, counts as a field
        left -= size
        said, digest, no, got = int(answer["content-length"]), hashlib.sha1(), 0, 0
        row = {"record_id": fields["warc-record-id"], "record_type": fields["warc-type"], "refers_to": fields.get("warc-refers-to"),
               "id": fields.get(ID_FIELD.lower()), "url": fields.get("warc-target-uri"),
               "said_bytes": said, "said_digest": fields["warc-payload-digest"].removeprefix("sha1:")}
        while True:
            data = stream.read(min(left, chunk)) if left else b""
            if left and not data:
                raise ValueError(f"{row['record_id']} ends early")
            digest.update(data)
            left, got = left - len(data), got + len(data)
            if not left and row["record_type"] == "response" and (got, base32(digest.digest())) != (said, row["said_digest"]):
                raise ValueError(f"{row['record_id']}: payload and headers differ")
            yield {**row, "no": no, "last": not left, "data": data if with_data else None, "bytes": got,
                   "digest": base32(digest.digest())}
            no += 1
            if not left:
                break


READ = ("record_id string, record_type string, refers_to string, id string, url string, said_bytes long, said_digest string, "
        "no int, last boolean, data binary, bytes long, digest string")


def read_chunks(manifest: DataFrame, chunk: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunk rows of all archives that the manifest lists: record fields, chunk number, data, and length and digest of
    the payload up to the chunk's end."""
    prepare_long(manifest.sparkSession)
    files = manifest.select("file").repartition(max(1, manifest.count()))
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = pa.schema([(c, kinds[t]) for c, t in (f.split() for f in READ.split(", "))])
    held = max(1, (16 << 20) // chunk) if with_data else 1000

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                storage, where = _storage(path)
                rows = []
                with storage.open_input_stream(where, compression=None) as f, gzip.open(f) as stream:
                    for row in records_of(stream, chunk, with_data):
                        rows.append(row)
                        if len(rows) >= held:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return files.mapInArrow(read, READ)


def read_records(manifest: DataFrame) -> DataFrame:
    """(id, record_type, payload_bytes, payload_digest, refers_to): one row for each record, read from the archives; length
    and digest of a revisit are those of the response it refers to (an id as a string, like refers_to)."""
    ends = read_chunks(manifest, with_data=False).filter("last").select(
        "record_id", "record_type", F.col("refers_to").alias("_to"), F.url_decode("id").alias("id"), "bytes", "digest", "said_digest")
    ends = shared_table(ends, "records_read")
    full = ends.filter(F.col("record_type") == "response")
    found = full.select(F.col("record_id").alias("_id"), F.col("id").alias("refers_to"), F.col("bytes").alias("payload_bytes"),
                        F.col("digest").alias("payload_digest"))
    revisits = ends.filter(F.col("record_type") == "revisit").join(found, F.col("_to") == F.col("_id"), "left")
    whole = revisits.withColumn("payload_digest", F.when(F.col("said_digest") == F.col("payload_digest"), F.col("payload_digest"))
                                .otherwise(F.raise_error(F.concat(F.col("record_id"), F.lit(" refers to another payload")))))
    columns = ["id", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    return full.select("id", "record_type", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                       F.lit(None).cast("string").alias("refers_to")).unionByName(whole.select(*columns))


def oracle(min_bytes: int = 0) -> str:
    """DuckDB SQL of the query's rows: base32 takes four characters from every 20 bits."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    text = " || ".join(f"substr('{letters}', 1 + ((('0x' || substr(hex, {5 * j + 1}, 5))::INTEGER >> {s}) & 31), 1)"
                       for j in range(8) for s in (15, 10, 5, 0))
    return f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex, sha256(payload) AS same FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= {min_bytes} THEN max(page_id) OVER (PARTITION BY same) ELSE page_id END AS kept FROM d)
SELECT page_id, payload_bytes, {text} AS payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM r"""
