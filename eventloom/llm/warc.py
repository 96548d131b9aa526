"""WARC archives: write captures as request, response or revisit, and metadata records; read and assemble them."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint_dir, cut, saved, table

RECORD = "record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, http string, payload binary, payload_bytes long, payload_digest string, fields map<string,string>, error string"
#: Copies of a row of a hot digest are matched in so many parts.
SALT = 32
#: First bytes of a gzip member; compressed bytes that are read at once.
MARK, STEP = b"\x1f\x8b\x08", 1 << 16
NUMBER = re.compile(r"[0-9]{1,18}")
#: Revisits, of two names of 32 characters each, that a broadcast may hold; more are joined by a shuffle of the rows.
BROADCAST_ROWS = 100_000


def write_archive(pages: DataFrame, folder: str, *, id: str = "page_id", url: str = "url", html: str = "html", revisit_bytes: int = 1000, file_mb: int = 16, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write three records for each row of pages into gzip-compressed WARC 1.1 files in folder.

    The payload is the html in UTF-8 (null: empty). Of rows with equal payloads of at least revisit_bytes, the one
    with the largest id (nulls last; of repeated ids any one) is a response, the others are revisits that refer to
    it; shorter payloads are all responses. Files hold about file_mb of records, so that a reader's task is small.
    The folder may be in any store that Spark writes to.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumns({"bytes": F.octet_length("html").cast("long"), "digest": F.sha1(F.col("html").cast("binary")), "at": F.monotonically_increasing_id()})
    # A lost executor must not give a row another record id: what it follows from, with `at` to tell repeated rows apart, is written first.
    rid = F.md5(F.concat_ws(" ", F.coalesce(F.col("id").cast("string"), F.lit("-")), "url", "digest", F.col("at").cast("string")))
    rows = saved(rows.withColumn("rid", rid))
    size = rows.agg(F.avg("bytes").alias("b")).first()["b"] or 0
    per_file = max(1, int(file_mb * 1e6 / (size + 1500)))  # captures
    long = rows.filter(F.col("bytes") >= revisit_bytes).select("id", "digest", "rid")
    first = long.groupBy("digest").agg(F.max(F.struct(F.coalesce("id", F.lit(-(1 << 63))).alias("i"), "rid")).alias("m"), F.count("*").alias("n"))
    first = first.filter("n > 1").select("digest", F.col("m.rid").alias("of"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    salted = long.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALT)).cast("int"))
    revisits = salted.join(first, ["digest", "salt"]).filter("rid <> of").select("rid", "of")
    revisits = cut(revisits)
    rows = rows.join(F.broadcast(revisits) if revisits.count() <= BROADCAST_ROWS else revisits, "rid", "left")
    urn = lambda c: F.concat(F.lit("<urn:uuid:"), F.regexp_replace(c, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    text = lambda s: F.lit(s)

    def record(kind, of, block, *more):
        head = F.concat(text("WARC/1.1\r\n"), line("WARC-Type", kind), line("WARC-Record-ID", of), line("WARC-Date", text(date)), line("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", " ")), *more)
        return F.concat(head, line("Content-Length", F.octet_length(block).cast("string")), text("\r\n"), block)

    again = F.col("of").isNotNull()
    http = F.concat(text("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.col("bytes").cast("string")), text("\r\n"))
    main = record(
        F.when(again, "revisit").otherwise("response"), urn(F.col("rid")), F.when(again, http).otherwise(F.concat(http, F.col("html"))),
        line("WARC-Payload-Digest", F.concat(text("sha1:"), F.col("digest"))), line("Content-Type", text("application/http; msgtype=response")),
        F.when(again, F.concat(line("WARC-Profile", text("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", urn(F.col("of"))))).otherwise(text("")),
    )
    concurrent = line("WARC-Concurrent-To", urn(F.col("rid")))
    request = record(text("request"), urn(F.md5(F.concat(F.col("rid"), text("q")))), F.concat(text("GET "), F.regexp_replace("url", r"[\r\n ]", "+"), text(" HTTP/1.1\r\n\r\n")), concurrent, line("Content-Type", text("application/http; msgtype=request")))
    meta = record(text("metadata"), urn(F.md5(F.concat(F.col("rid"), text("m")))), F.concat(F.when(F.col("id").isNotNull(), line("id", F.col("id").cast("string"))).otherwise(text("")), line("crawl", text("synthetic"))), concurrent, line("Content-Type", text("application/warc-fields")))
    out = rows.select(F.explode(F.array(request, main, meta)).alias("value"))
    out.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", per_file * 3).text(folder)


def members(content: bytes) -> tuple[bytes, list[str]]:
    """What the gzip members of content hold, and what is wrong with them.

    Of a broken member what comes before the fault is kept, and reading goes on at the next member's mark.
    """
    parts, wrong, at = [], [], 0
    while at < len(content):
        if content[at : at + 2] != MARK[:2]:
            if content[at:].strip(b"\0"):
                wrong.append("bytes after a gzip member")
            at = content.find(MARK, at + 1)
            if at < 0:
                break
            continue
        d, place = zlib.decompressobj(31), at
        try:
            while place < len(content) and not d.eof:
                parts.append(d.decompress(content[place : place + STEP]))
                place += STEP
            parts.append(d.flush())
        except zlib.error as e:
            wrong.append(f"gzip member: {e}")
            at = content.find(MARK, at + 1)
            if at < 0:
                break
            continue
        if not d.eof:
            wrong.append("gzip member is cut")
            break
        at = min(place, len(content)) - len(d.unused_data)
    return b"".join(parts), wrong


def records(content: bytes) -> Iterator[dict]:
    """Records of one archive, plain or gzip-compressed (of one member or one a record).

    What is broken is a row with `error` beside the others, not the end of the job: a record whose header or block is
    cut, one whose Content-Length is none (it ends at the next record's first line), and a faulty gzip member.
    """
    wrong: list[str] = []
    if content[:2] == MARK[:2]:
        content, wrong = members(content)
    at = 0
    while (at := content.find(b"WARC/1.", at)) >= 0:
        end = content.find(b"\r\n\r\n", at)
        if end < 0:
            yield {"error": "header is cut"}
            break
        head = _fields(content[at:end].split(b"\r\n")[1:])
        told = head.get("content-length", "0")
        named = {"record_id": head.get("warc-record-id"), "type": head.get("warc-type"), "target_uri": head.get("warc-target-uri"), "date": head.get("warc-date")}
        if not NUMBER.fullmatch(told):
            yield {**named, "error": f"Content-Length: {told}"}
            at = end
            if (at := content.find(b"\r\n\r\nWARC/1.", at)) < 0:
                break
            continue
        size = int(told)
        block = content[end + 4 : end + 4 + size]
        if len(block) < size:
            yield {**named, "error": f"block is cut: {len(block)} of {size} bytes"}
            # A length that is too large hides no record that follows.
            if (at := content.find(b"\r\n\r\nWARC/1.", end)) < 0:
                break
            continue
        at = end + 4 + size
        kind = named["type"]
        http, payload, fields = None, None, {}
        if kind in ("response", "revisit", "request") and "application/http" in head.get("content-type", ""):
            front, _, payload = block.partition(b"\r\n\r\n")
            lines = front.split(b"\r\n")
            http, fields = lines[0].decode("utf-8", "replace"), _fields(lines[1:])
        elif kind == "metadata":
            fields = _fields(block.split(b"\r\n"))
        else:
            payload = block
        full = payload is not None and kind != "revisit"
        digest = head.get("warc-payload-digest", "").rpartition(":")[2] or None
        length = len(payload) if full else int(fields["content-length"]) if kind == "revisit" and NUMBER.fullmatch(fields.get("content-length", "")) else None
        yield {
            **named, "concurrent_to": head.get("warc-concurrent-to"), "refers_to": head.get("warc-refers-to"), "http": http, "payload": payload if full else None,
            "payload_bytes": length, "payload_digest": hashlib.sha1(payload).hexdigest() if full else digest, "fields": list(fields.items()), "error": None,
        }
    for message in wrong:
        yield {"error": message}


def _fields(lines: list[bytes]) -> dict[str, str]:
    return {k.strip().decode("utf-8", "replace").lower(): v.strip().decode("utf-8", "replace") for k, sep, v in (x.partition(b":") for x in lines) if sep}


def read_archive(spark: SparkSession, folder: str, glob: str = "*", *, payloads: bool = True) -> DataFrame:
    """One row a record of the archives in folder, and one with `error` for each broken one (see records()).

    A task reads whole files, which the writer keeps small. Without payloads, the rows hold their size and digest only.
    Each use of the result parses the archives; who needs it more than once writes it first.
    """
    schema = pa.schema([*[(n, pa.string()) for n in ("record_id", "type", "concurrent_to", "refers_to", "target_uri", "date", "http")], ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("error", pa.string())])
    kept = RECORD
    if not payloads:
        schema = schema.remove(schema.get_field_index("payload"))
        kept = RECORD.replace("payload binary, ", "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b["content"]:
                held, size = [], 0
                for r in records(content.as_py()):
                    if not payloads:
                        r.pop("payload", None)
                    held.append(r)
                    size += len(r.get("payload") or b"") + 1000
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select("content").mapInArrow(run, kept)


def assemble(recs: DataFrame) -> DataFrame:
    """One nested row a capture: the response or revisit, with the request and the metadata concurrent to it.

    Records are joined by WARC-Concurrent-To. A capture without a request or metadata has null there; requests and
    metadata concurrent to no capture, and records without a record id, go; an id that comes twice gives a row each.
    `original` is the metadata's id field of the capture that a revisit refers to; those referred to are few keys
    with many rows, so they are matched in SALT parts. Broken records (`error`) take no part. recs may lack payloads,
    and is used five times: it is best a written table.
    """
    recs = recs.filter("error is null")
    full = [c for c in ("payload", "payload_bytes", "payload_digest") if c in recs.columns]
    head = ["record_id", "target_uri", "date", "http", "fields"]
    main = recs.filter(F.col("type").isin("response", "revisit") & F.col("record_id").isNotNull())
    main = main.select(F.col("record_id").alias("capture_id"), "type", "refers_to", F.struct(*head, *full).alias("response"))
    side = lambda kind: recs.filter((F.col("type") == kind) & F.col("concurrent_to").isNotNull()).select(F.col("concurrent_to").alias("capture_id"), F.struct(*head).alias(kind))
    out = main.join(side("request"), "capture_id", "left").join(side("metadata"), "capture_id", "left")
    ids = side("metadata").select("capture_id", F.col("metadata.fields")["id"].alias("original"))
    referred = recs.filter(F.col("type") == "revisit").select(F.col("refers_to").alias("capture_id")).distinct()
    referred = ids.join(referred, "capture_id").select(F.col("capture_id").alias("refers_to"), "original", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    return out.withColumn("salt", F.pmod(F.xxhash64("capture_id"), F.lit(SALT)).cast("int")).join(referred, ["refers_to", "salt"], "left").drop("salt")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives in the shared folder, read back and assembled."""
    folder = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4()}"
    write_archive(table(spark, sf_dir, "pages"), folder)
    captures = assemble(saved(read_archive(spark, folder, "*.gz", payloads=False)))
    return captures.select(
        F.col("metadata.fields")["id"].cast("long").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("original").cast("long").alias("refers_to"),
    )


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to FROM m
"""
