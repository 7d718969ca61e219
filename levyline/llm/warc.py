"""WARC archives: write page captures, read archives back, assemble transactions.

Writing: every page row becomes a request, a response (or revisit) and a metadata record in a gzip archive
with one member a record. A payload of at least ``MIN_REVISIT_BYTES`` that several rows share is stored once,
by the row with the smallest id; the others are ``revisit`` records that refer to it. Archives go to the
shared folder, under names of the task attempt's own; only archives that the committed manifest lists are ever
read, so files of lost or repeated attempts do no harm.

Reading: archives are streamed record by record by their Content-Length, one task a few archives.

Assembly: request and metadata records are joined to the response, revisit or resource record of their
capture through concurrent-to identifiers, given by either side, and also through another record of the
capture (one hop). Each capture is one nested row; records that reach none make a capture without response.

Defined results: null payloads are empty; null URLs are empty; a null page id stays null. Rows that repeat an id
get records of their own, told apart by their place among the repeats; with equal payloads the first is the response.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, ship, stored

MIN_REVISIT_BYTES = 100
#: An archive is closed beyond this size.
ARCHIVE_BYTES = 256 << 20
LEVEL = 4
DATE = "2024-02-29T00:00:00Z"
SPACE_ID = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
ANCHORS = ("response", "revisit", "resource")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORDS = (
    "record_id string, type string, target_uri string, date string, concurrent_to array<string>, refers_to string, "
    "declared_digest string, payload_digest string, payload_bytes long, fields map<string,string>, payload binary"
)


def _id(role: str, *key) -> str:
    return f"<{uuid.uuid5(SPACE_ID, ':'.join([role, *map(str, key)])).urn}>"


def _safe(url: str) -> str:
    """A header value cannot hold control characters."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(kind: str, record_id: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {DATE}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def transaction(page_id, nth: int, url: str, payload: bytes, digest: str, refers_to: tuple | None) -> list[bytes]:
    """The three records of a capture."""
    me = _id("response", page_id, nth)
    uri = ("WARC-Target-URI", _safe(url))
    host, _, path = url.partition("://")[2].partition("/")
    ask = f"GET /{_safe(path)} HTTP/1.1\r\nHost: {_safe(host)}\r\n\r\n".encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    about = [uri, ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    out = [record("request", _id("request", page_id, nth), [uri, ("WARC-Concurrent-To", me), ("Content-Type", "application/http;msgtype=request")], ask)]
    if refers_to:
        out.append(record("revisit", me, [*about, ("WARC-Refers-To", _id("response", *refers_to)), ("WARC-Profile", PROFILE)], http))
    else:
        out.append(record("response", me, about, http + payload))
    fields = b"" if page_id is None else f"page-id: {page_id}\r\n".encode()
    out.append(record("metadata", _id("metadata", page_id, nth), [uri, ("WARC-Concurrent-To", me), ("Content-Type", "application/warc-fields")], fields))
    return out


def _compressed(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, wbits=31)
    return z.compress(data) + z.flush()


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _write(root: str):
    def run(batches):
        out, path, size, n, done = None, "", 0, 0, []
        fs, folder = _open(root)
        for b in batches:
            for i in range(b.num_rows):
                page, nth, url, html, digest, to, to_nth = (c[i].as_py() for c in b.columns)
                if out is None:
                    path = f"part-{uuid.uuid4().hex}.warc.gz"
                    fs.create_dir(folder, recursive=True)
                    out, size, n = fs.open_output_stream(f"{folder}/{path}", compression=None), 0, 0
                for r in transaction(page, nth, url or "", (html or "").encode("utf-8", "replace"), digest, None if to_nth is None else (to, to_nth)):
                    z = _compressed(r)
                    out.write(z)
                    size += len(z)
                    n += 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((f"{root}/{path}", n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{root}/{path}", n, size))
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64()))], ["path", "records", "bytes"])

    return run


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write all rows as captures; returns the manifest (path, records, bytes) of the archives."""
    spark = pages.sparkSession
    ship(spark)
    html = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"), F.octet_length(html).alias("size"))
    repeats = rows.groupBy("page").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeats.isEmpty():
        rows = rows.withColumn("nth", F.lit(0))
    else:
        rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("page").orderBy("digest", "url")) - 1)
    named = rows.where(F.col("page").isNotNull())  # a row without an id refers to nothing and nothing to it
    shared = named.where(F.col("size") >= MIN_REVISIT_BYTES).groupBy("digest").agg(F.min(F.struct("page", "nth")).alias("first"), F.count(F.lit(1)).alias("n"))
    rows = rows.join(shared.where("n > 1").select("digest", "first"), "digest", "left")
    other = F.col("page").isNotNull() & F.col("first").isNotNull() & ~F.struct("page", "nth").eqNullSafe(F.col("first"))
    rows = rows.select("page", "nth", "url", "html", "digest", F.when(other, F.col("first.page")).alias("to"), F.when(other, F.col("first.nth")).alias("to_nth"))
    return stored(rows.mapInArrow(_write(scratch(spark, "warc")), "path string, records long, bytes long"), "manifest")


def parse(stream, with_payload: bool):
    """Records of one archive, plain or gzip."""
    raw = io.BufferedReader(stream, 1 << 20) if not isinstance(stream, io.BufferedReader) else stream
    r = io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 20) if raw.peek(2)[:2] == b"\x1f\x8b" else raw
    while line := r.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head: dict[str, list[str]] = {}
        while (line := r.readline()).strip():
            k, _, v = line.decode("utf-8", "replace").partition(":")
            head.setdefault(k.strip().lower(), []).append(v.strip())
        size = int(head["content-length"][0])
        block = r.read(size)
        if len(block) < size:
            raise ValueError("the archive ends within a record")
        one = lambda k: head.get(k, [None])[0]
        kind, payload, fields = one("warc-type"), None, {}
        if "http" in (one("content-type") or ""):
            payload = block.partition(b"\r\n\r\n")[2]
        elif "warc-fields" in (one("content-type") or ""):
            fields = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").splitlines() if ":" in x)}
        elif kind == "resource":
            payload = block
        yield {
            "record_id": one("warc-record-id"),
            "type": kind,
            "target_uri": one("warc-target-uri"),
            "date": one("warc-date"),
            "concurrent_to": head.get("warc-concurrent-to", []),
            "refers_to": one("warc-refers-to"),
            "declared_digest": (one("warc-payload-digest") or "").removeprefix("sha256:") or None,
            "payload_digest": None if payload is None or kind == "revisit" else hashlib.sha256(payload).hexdigest(),
            "payload_bytes": None if payload is None or kind == "revisit" else len(payload),
            "fields": list(fields.items()),
            "payload": payload if with_payload else None,
        }


def _read(with_payload: bool):
    kinds = {
        "concurrent_to": pa.list_(pa.string()),
        "payload_bytes": pa.int64(),
        "fields": pa.map_(pa.string(), pa.string()),
        "payload": pa.binary(),
    }
    names = [x.split()[0] for x in re.split(r", (?=\w+ )", RECORDS)]
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                fs, p = _open(path)
                rows, size = [], 0
                with fs.open_input_file(p) as f:
                    for r in parse(f, with_payload):
                        rows.append(r)
                        size += 500 + len(r["payload"] or b"")
                        if size > 4_000_000:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_archives(spark: SparkSession, manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """All records of the archives that ``manifest(path)`` lists."""
    ship(spark)
    files = manifest.select("path")
    return files.repartition(max(1, files.count())).mapInArrow(_read(with_payload), RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """Nested captures (capture_id, target_uri, response, request, metadata) of WARC records.

    The records are written to the shared folder first: archives are parsed once, and the joins know the sizes.
    """
    records = stored(records, "records")
    anchor = F.col("type").isin(*ANCHORS)
    others = records.where(~anchor & F.col("record_id").isNotNull())
    anchors = records.where(anchor & F.col("record_id").isNotNull())
    claims = others.select(F.col("record_id").alias("other"), F.explode("concurrent_to").alias("target"))
    claims = claims.union(anchors.select(F.explode("concurrent_to").alias("other"), F.col("record_id").alias("target"))).distinct()
    direct = claims.join(anchors.select(F.col("record_id").alias("target")).distinct(), "target").select("other", F.col("target").alias("capture_id"))
    via = claims.join(direct.select("other"), "other", "left_anti").join(direct.withColumnsRenamed({"other": "target"}), "target").select("other", "capture_id")
    links = direct.unionByName(via).groupBy("other").agg(F.min("capture_id").alias("capture_id"))
    of = others.join(links.withColumnRenamed("other", "record_id"), "record_id", "left").withColumn("capture_id", F.coalesce("capture_id", "record_id"))
    answer = F.struct("record_id", "type", "date", "target_uri", "refers_to", "declared_digest", "payload_digest", "payload_bytes", "payload")
    ask = F.struct("record_id", "date", "target_uri", "payload")
    note = F.struct("record_id", "type", F.map_entries("fields").alias("fields"))
    rows = anchors.select(F.col("record_id").alias("capture_id"), answer.alias("response"))
    rows = rows.unionByName(of.select("capture_id", F.when(F.col("type") == "request", ask).alias("request"), F.when(F.col("type") != "request", note).alias("note")), allowMissingColumns=True)
    out = rows.groupBy("capture_id").agg(F.max("response").alias("response"), F.min("request").alias("request"), F.sort_array(F.collect_list("note")).alias("metadata"))
    uri = F.coalesce("response.target_uri", "request.target_uri")
    return out.select("capture_id", uri.alias("target_uri"), "response", "request", "metadata")


def resolve(captures: DataFrame, field: str = "page-id") -> DataFrame:
    """One row a capture with a response: (value of ``field`` in its metadata, bytes and digest of the full
    payload, record type, and that field of the capture a revisit refers to)."""
    entries = F.flatten(F.transform("metadata", lambda m: m["fields"]))
    value = F.get(F.filter(entries, lambda e: e["key"] == field), 0)["value"]
    rows = captures.where("response is not null").select("response.*", value.alias("value"))
    held = rows.where("type <> 'revisit'").groupBy("record_id").agg(F.min("value").alias("to_value"), F.min("payload_bytes").alias("to_bytes"), F.min("payload_digest").alias("to_digest"))
    held = held.withColumnRenamed("record_id", "refers_to")
    out = rows.select("value", "type", "refers_to", "declared_digest", "payload_digest", "payload_bytes").join(held, "refers_to", "left")
    back = F.col("type") == "revisit"
    return out.select(
        "value",
        F.when(back, F.col("to_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(back, F.col("to_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(back, F.col("to_value")).alias("refers_to"),
    )
