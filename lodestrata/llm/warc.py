"""Operator 7: WARC archives, written with revisit records and read back by boundary-chain verification."""

from __future__ import annotations

import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, shared_dir

CHUNK = 1 << 20
FILE_BYTES = 16 << 20
LEAST_PAYLOAD = 1000
MAGIC = re.compile(rb"WARC/1\.[01]\r\n")
REVISIT = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_warc(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", least: int = LEAST_PAYLOAD) -> None:
    """Write one record per page, uncompressed. Of pages with equal payloads of at least ``least`` bytes the one with the
    largest page_id is a response, the others revisit it. Files hold about 16 MB. Null html is an empty payload."""
    page = pages.select("page_id", F.regexp_replace("url", r"[\r\n]", "").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    page = page.withColumns({"digest": F.sha1(F.col("html").cast("binary")), "size": F.octet_length("html")})
    last = page.where(F.col("size") >= least).groupBy(F.unhex("digest").alias("d")).agg(F.max("page_id").alias("original"), F.count("*").alias("copies")).where("copies > 1").select("d", "original")
    mean = page.agg(F.avg("size")).first()[0]
    marks = page.select("page_id", "digest").join(last, F.unhex("digest") == F.col("d")).where("page_id <> original").select("page_id", "digest", "original").distinct()
    page = page.join(materialize(marks), ["page_id", "digest"], "left")
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    revisit = F.col("original").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    body = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\n"),
        _line("WARC-Record-ID", urn(F.coalesce(F.col("page_id").cast("string"), F.lit("none")))),
        F.lit(f"WARC-Date: {date}\r\n"),
        _line("WARC-Target-URI", F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n")),
        _line("WARC-Refers-To", urn(F.col("original"))),
        F.when(revisit, F.lit(f"WARC-Profile: {REVISIT}\r\n")).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n")),
    )
    records = max(1, int(FILE_BYTES / ((mean or 0) + 600)))
    page.select(F.concat(head, body).alias("value")).write.option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", records).text(path)


def parse_record(data: bytes, at: int) -> dict | None:
    """The record whose magic stands at ``at``: its headers and the offsets of its block and of its successor."""
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        return None
    head = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        head[name.strip().lower()] = value.strip()
    if not head.get(b"content-length", b"").isdigit() or b"warc-type" not in head:
        return None
    block = end + 4
    return {"head": head, "block": block, "next": block + int(head[b"content-length"]) + 4}


def _candidates(batches):
    cols = {k: [] for k in ("file", "chunk", "at", "next", "size", "type", "id", "refers_to", "uri", "digest", "http_length", "payload_bytes", "payload_sha1")}

    def flush():
        out = pa.RecordBatch.from_pydict(cols, schema=_SCHEMA)
        for v in cols.values():
            v.clear()
        return out

    for b in batches:
        for path, content in zip(b.column("path"), b.column("content"), strict=True):
            data = content.as_buffer().to_pybytes()
            for m in MAGIC.finditer(data):
                r = parse_record(data, m.start())
                if r is None or r["next"] > len(data) or data[r["next"] - 4 : r["next"]] != b"\r\n\r\n":
                    continue
                block = data[r["block"] : r["next"] - 4]
                http, _, payload = block.partition(b"\r\n\r\n")
                length = re.search(rb"(?i)^content-length:\s*(\d+)", http, re.M)
                text = lambda k: v.decode("utf-8", "replace") if (v := r["head"].get(k)) is not None else None  # noqa: B023, E731
                for k, v in zip(
                    cols,
                    (path.as_py(), m.start() // CHUNK, m.start(), r["next"], len(data), text(b"warc-type"), text(b"warc-record-id"), text(b"warc-refers-to"), text(b"warc-target-uri"), text(b"warc-payload-digest"), int(length[1]) if length else None, len(payload), hashlib.sha1(payload).hexdigest()),
                    strict=True,
                ):
                    cols[k].append(v)
                if len(cols["at"]) >= 10_000:
                    yield flush()
    yield flush()


_TYPES = "file string, chunk long, at long, next long, size long, type string, id string, refers_to string, uri string, digest string, http_length long, payload_bytes long, payload_sha1 string"
_SCHEMA = pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (f.split() for f in _TYPES.split(", "))])


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of uncompressed archives: file, at, type, id, refers_to, uri, digest, http_length, payload_bytes, payload_sha1.

    Every magic that starts a well-formed record becomes a candidate with its successor's offset. Within a chunk of 1 MB
    successors are followed at once; between chunks, pointer jumping from offset 0 doubles its reach at each step. Only
    reachable candidates are records, so a whole record inside a payload is none. After a break in the chain (a truncated
    file) the file's further records are not returned. Files without records and an empty folder give no rows.
    """
    found = materialize(spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(_candidates, _TYPES))

    def leave(pdf):
        """Of each candidate, the first offset outside its chunk that its chain reaches."""
        step = dict(zip(pdf["at"], pdf["next"], strict=True))
        exit_of: dict[int, int] = {}
        for at in sorted(step, reverse=True):
            exit_of[at] = exit_of.get(step[at], step[at])
        pdf["to"] = [exit_of[a] for a in pdf["at"]]
        return pdf[["file", "chunk", "at", "to"]]

    exits = materialize(found.select("file", "chunk", "at", "next").groupBy("file", "chunk").applyInPandas(leave, "file string, chunk long, at long, to long"))
    targets = exits.select("file", F.col("to").alias("at")).distinct()
    jump = exits.join(targets, ["file", "at"], "left_semi").union(exits.where("at = 0")).select("file", "at", "to").distinct()
    jump, reached, held = materialize(jump), exits.where("at = 0").select("file", "at"), -1
    while True:
        reached = materialize(reached.union(reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))).distinct())
        if (n := reached.count()) == held:
            break
        held = n
        nxt = jump.select("file", F.col("at").alias("to"), F.col("to").alias("far"))
        jump = materialize(jump.join(nxt, ["file", "to"], "left").select("file", "at", F.coalesce("far", "to").alias("to")))

    def follow(pdf):
        step = dict(zip(pdf["at"], pdf["next"], strict=True))
        kept = set()
        for at in pdf.loc[pdf["entry"], "at"]:
            while at in step and at not in kept:
                kept.add(at)
                at = step[at]
        return pdf[pdf["at"].isin(kept)][["file", "at"]]

    marked = found.select("file", "chunk", "at", "next").join(reached.withColumn("entry", F.lit(True)), ["file", "at"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    true = marked.groupBy("file", "chunk").applyInPandas(follow, "file string, at long")
    return found.join(true, ["file", "at"], "left_semi").drop("chunk", "next", "size")


def archive_round_trip(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html; other columns are ignored) as archives under ``path`` (default: a new folder in
    the shared one) and return what reading them gives, a row per record: page_id, payload_bytes, payload_digest (of the
    full payload, also for revisits), record_type, refers_to. A null page_id is read back as null; a repeated page_id
    gives a record for each row; equal payloads under one id are all responses. An empty table gives no rows."""
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(pages, path)
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    revisit = F.col("type") == "revisit"
    return read_warc(spark, path).select(
        page("id").alias("page_id"),
        F.when(revisit, F.col("http_length")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("digest", "^sha1:", "")).otherwise(F.col("payload_sha1")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(revisit, page("refers_to")).alias("refers_to"),
    )


def op7_warc(spark, sf_dir: str) -> DataFrame:
    return archive_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM q
"""
