r"""WARC archives: written by parallel tasks, read back by a sequential
reader (one gzip member per record, incremental zlib decompression,
content-length framing, digest verification).

Records of equal payloads of at least ``MIN_REVISIT`` bytes: the one with the
largest id is the response, the others are revisits that refer to it.

Defined cases: a null payload is empty; a null id is written as an empty id
and read back as null, and counts as smaller than any other; a null URL has
no target header, and control characters in a URL are percent-encoded; rows
that repeat an id with an equal payload share the role of that id; an empty
table gives no archive and an empty result; payloads and headers of any length
are written and read whole.  Only the id, URL and payload
columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import open_store, scratch

MIN_REVISIT = 1000
#: A new archive file begins after so many compressed bytes.
FILE_BYTES = 256 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CHUNK = 1 << 16


def _clean(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id, url, payload: bytes, refers_to=None, digest: str | None = None) -> bytes:
    """One record as a gzip member.  A revisit has the response's HTTP head
    (with the full payload's length) and no payload."""
    digest = digest or hashlib.sha1(payload).hexdigest()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 2024-01-01T00:00:00Z"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


class Damaged(ValueError):
    """An archive that breaks off or whose framing or digest is wrong."""


def members(stream) -> Iterator[bytearray]:
    """The decompressed bytes of each gzip member, read in chunks."""
    data = stream.read(_CHUNK)
    while data:
        z, out = zlib.decompressobj(31), bytearray()
        while not z.eof:
            if not data:
                raise Damaged("the archive ends inside a record")
            out += z.decompress(data)
            data = z.unused_data if z.eof else stream.read(_CHUNK)
        yield out
        data = data or stream.read(_CHUNK)


def _head(raw: bytes, what: str) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith(what):
        raise Damaged(f"no {what} line")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _verify(label: str | None, data: bytes, what: str) -> str | None:
    """The digest of ``data`` as bare lower-case hex, if ``label`` names one in
    hex or base32 that this Python can check; it must be right."""
    name, _, value = (label or "").partition(":")
    name = name.lower().replace("-", "")
    if not value or name not in hashlib.algorithms_available or name.startswith("shake"):
        return None
    found = hashlib.new(name, data)
    if value.lower() != found.hexdigest() and value.upper().rstrip("=") != base64.b32encode(found.digest()).decode().rstrip("="):
        raise Damaged(what)
    return found.hexdigest()


def read_records(stream) -> Iterator[dict]:
    """Responses and revisits in file order; framing and digests are
    verified.  Records of other types (``warcinfo``, ``request``, ...) are
    verified and passed over; a digest that a record lacks is computed."""
    for raw in members(stream):
        cut = raw.find(b"\r\n\r\n")
        if cut < 0:
            raise Damaged("no end of the record's header")
        head = _head(bytes(raw[:cut]), "WARC/")
        size = int(head["content-length"])
        block = bytes(raw[cut + 4:cut + 4 + size])
        if len(block) != size or raw[cut + 4 + size:] != b"\r\n\r\n":
            raise Damaged("the block's length is not the content length")
        _verify(head.get("warc-block-digest"), block, "block digest")
        kind = head.get("warc-type")
        if kind not in ("response", "revisit"):
            continue
        http, _, payload = block.partition(b"\r\n\r\n")
        length = _head(http, "HTTP/").get("content-length")
        label = head.get("warc-payload-digest")
        if kind == "response":
            if length is not None and len(payload) != int(length):
                raise Damaged("the payload's length is not its content length")
            digest = _verify(label, payload, "payload digest") or hashlib.sha1(payload).hexdigest()
        else:
            digest = label and label.partition(":")[2].lower()
        urn = lambda k: (head.get(k) or "").removeprefix("<urn:page:").removesuffix(">") or None
        yield {"id": urn("warc-record-id"), "url": head.get("warc-target-uri"), "payload_bytes": len(payload) if length is None else int(length),
               "payload_digest": digest, "record_type": kind, "refers_to": urn("warc-refers-to"),
               "payload": payload if kind == "response" else None}


def _writer(uri: str, file_bytes: int):
    def write(batches):
        store, base = open_store(uri)
        task = TaskContext.get()
        # each attempt writes its own names; only files that a finished task
        # reports are read, so a lost or repeated attempt leaves no trace
        name = f"{base}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        out, n, done = None, 0, []
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    done.append([f"{name}-{n:04d}.warc.gz", 0, 0])
                    out, n = store.open_output_stream(done[-1][0], compression=None), n + 1
                raw = record(r["id"], r["url"], (r["payload"] or "").encode(), r["refers_to"], r["digest"])
                out.write(raw)
                done[-1][1] += 1
                done[-1][2] += len(raw)
                if done[-1][2] >= file_bytes:
                    out = out.close()
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
                                         ["path", "records", "bytes"])
    return write


def with_roles(rows: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Adds digest and refers_to (null for responses).  Only (digest, id)
    pairs of long payloads are grouped, with partial maxima in each task; the
    join back touches the few digests that occur twice.  A short payload has a
    key of its own there, so equal short ones don't meet."""
    rows = rows.withColumn("_raw", F.encode(F.coalesce("payload", F.lit("")), "UTF-8"))
    rows = rows.withColumn("digest", F.sha1("_raw")).withColumn("_n", F.octet_length("_raw")).drop("_raw")
    first = (rows.where(F.col("_n") >= min_bytes).groupBy("digest", "_n")
             .agg(F.max("id").alias("_first"), F.count(F.lit(1)).alias("_k")).where("_k > 1").drop("_k"))
    first = first.select(F.col("digest").alias("_key"), F.col("_n").alias("_m"), "_first")
    key = F.when(F.col("_n") >= min_bytes, F.col("digest")).otherwise(F.concat(F.lit("short "), F.monotonically_increasing_id().cast("string")))
    both = rows.withColumn("_key", key).join(first.withColumnRenamed("_m", "_n"), ["_key", "_n"], "left").drop("_key")
    other = F.col("_first").isNotNull() & ~F.col("id").eqNullSafe(F.col("_first"))
    return both.withColumn("refers_to", F.when(other, F.col("_first"))).drop("_first", "_n")


def write_archives(rows: DataFrame, uri: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write rows (id, url, payload) below ``uri``; returns the table of the
    archive files (path, records, bytes), itself stored beside them."""
    spark = rows.sparkSession
    store, base = open_store(uri)
    store.create_dir(base, recursive=True)
    ready = with_roles(rows).select("id", "url", "payload", "refers_to", "digest")
    files = ready.mapInArrow(_writer(uri, file_bytes), "path string, records long, bytes long")
    files.write.parquet(f"{uri}-files")
    return spark.read.parquet(f"{uri}-files")


def _reader(uri: str, id_type: str):
    kind = {"bigint": pa.int64(), "int": pa.int32()}.get(id_type, pa.string())
    cast = (lambda x: x) if kind == pa.string() else (lambda x: None if x is None else int(x))

    def read(batches):
        store, _ = open_store(uri)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with store.open_input_stream(path, compression=None) as f:
                    rows = []
                    for r in read_records(f):
                        r.pop("payload")
                        rows.append(r | {"id": cast(r["id"]), "refers_to": cast(r["refers_to"])})
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("id", kind), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", kind)])
    return read


def read_archives(files: DataFrame, uri: str, id_type: str = "bigint") -> DataFrame:
    """One row per record, without payloads; one task reads a file from its
    beginning to its end."""
    spark = files.sparkSession
    n = max(1, files.count())
    paths = files.select("path").repartition(min(n, 4 * max(spark.sparkContext.defaultParallelism, 1) + n // 8))
    return paths.mapInArrow(_reader(uri, id_type), f"id {id_type}, url string, payload_bytes long, payload_digest string, "
                            f"record_type string, refers_to {id_type}")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a record for every page, read the archives back."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    id_type = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select(F.col("page_id").alias("id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("payload"))
    uri = scratch(spark, "warc")
    files = write_archives(rows, uri)
    return read_archives(files, uri, id_type).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, sha1(t) AS payload_digest FROM p),
f AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_ FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id IS DISTINCT FROM first_ THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT} AND page_id IS DISTINCT FROM first_ THEN first_ END AS refers_to
FROM f
"""
