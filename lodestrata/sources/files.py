"""Sources beyond Spark's own: source configurations, archives, console logs, JSON trees, request traces."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import spread
from .shared import store as to_shared

CONFIG = "source_id string, name string, entrypoint string, workflow string, seeds array<string>, update_category string, allowed_hosts array<string>, max_depth int, max_urls int, discover_apis boolean"


def source_configs(spark: SparkSession, path: str) -> DataFrame:
    """S01, Z21. Configurations from JSON (or YAML, where a YAML library is installed) with a list or a map under ``sources``."""
    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    try:
        doc = json.loads(text)
    except ValueError:
        import yaml

        doc = yaml.safe_load(text)
    rows = doc["sources"] if isinstance(doc, dict) else doc
    if isinstance(rows, dict):
        rows = [{"source_id": k, **v} for k, v in rows.items()]
    names = [f.split()[0] for f in CONFIG.split(", ")]
    defaults = {"max_depth": 2, "max_urls": 250, "discover_apis": False, "seeds": [], "allowed_hosts": []}
    return spark.createDataFrame([tuple(r.get(n, defaults.get(n)) for n in names) for r in rows], CONFIG)


def seed_urls(configs: DataFrame) -> DataFrame:
    """U01. Entrypoint and seeds of each source, in order, without repeats."""
    every = F.array_distinct(F.filter(F.concat(F.array("entrypoint"), F.coalesce("seeds", F.array().cast("array<string>"))), lambda u: u.isNotNull() & (u != "")))
    return configs.select("source_id", F.posexplode(every).alias("ord", "url"))


def scope_hosts(configs: DataFrame) -> DataFrame:
    """F53, U08, Z03. Hosts in scope of each source: of its seeds, and the allowed ones."""
    from ..functions.urls import host

    of_seeds = seed_urls(configs).select("source_id", host(F.col("url")).alias("host"))
    return of_seeds.union(configs.select("source_id", F.explode("allowed_hosts")).select("source_id", F.rtrim(F.lower(F.trim("col"))))).where("host <> ''").distinct()


def is_archive(name: Column) -> Column:
    """S13."""
    return F.lower(name).rlike(r"\.(zip|tar|gz|tgz|bz2)$")


def archive_entries(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """S12. Entries of ZIP and TAR archives held in binary rows: path, filename, size_bytes, extension. Folders and hidden
    files are left out; what is neither archive gives no rows. Works on Arrow batches, one file at a time."""

    def run(frames):
        import io
        import os
        import tarfile
        import zipfile

        import pandas as pd

        for f in frames:
            rows = []
            for p, data in zip(f[path], f[content], strict=True):
                if data is None:
                    continue
                try:
                    with zipfile.ZipFile(io.BytesIO(data)) as z:
                        found = [(i.filename, i.file_size) for i in z.infolist() if not i.is_dir()]
                except zipfile.BadZipFile:
                    try:
                        with tarfile.open(fileobj=io.BytesIO(data)) as t:
                            found = [(m.name, m.size) for m in t.getmembers() if m.isfile()]
                    except tarfile.TarError:
                        continue
                rows += [(p, n, s, os.path.splitext(n)[1].lower()) for n, s in found if not os.path.basename(n).startswith(".")]
            yield pd.DataFrame(rows, columns=[path, "filename", "size_bytes", "extension"])

    return files.select(path, content).mapInPandas(run, f"{path} string, filename string, size_bytes long, extension string")


def gunzip(content: Column, limit: int = 1 << 20) -> Column:
    """S09. Content behind a gzip signature, at most ``limit`` bytes of it (null beyond); other content unchanged."""
    @F.pandas_udf("binary")
    def inflate(values: pd.Series) -> pd.Series:
        import zlib

        def one(data):
            if data is None or data[:2] != b"\x1f\x8b":
                return data
            d = zlib.decompressobj(31)
            try:
                out = d.decompress(data, limit + 1)
            except zlib.error:
                return None
            return out if len(out) <= limit else None

        return values.map(one)

    return inflate(content)


def decode_log(content: Column) -> Column:
    """S21, Z26. (text, charset) of a console log: by byte-order mark, strict UTF-8, else the best scored of UTF-16 and
    Latin-1, by replacement and control characters."""
    bom = F.hex(F.substring(content, 1, 3))
    zeros = F.regexp_count(F.hex(F.substring(content, 1, 400)), F.lit("00"))
    charset = F.when(bom == "EFBBBF", "UTF-8").when(bom.startswith("FFFE"), "UTF-16LE").when(bom.startswith("FEFF"), "UTF-16BE").when(F.is_valid_utf8(content.cast("string")) & (zeros * 4 < F.length(F.substring(content, 1, 400))), "UTF-8").when(zeros * 4 >= F.length(F.substring(content, 1, 400)), F.when(F.hex(F.substring(content, 2, 1)) == "00", "UTF-16LE").otherwise("UTF-16BE")).otherwise("ISO-8859-1")
    text = F.when(charset == "UTF-16LE", F.decode(content, "UTF-16LE")).when(charset == "UTF-16BE", F.decode(content, "UTF-16BE")).when(charset == "ISO-8859-1", F.decode(content, "ISO-8859-1")).otherwise(content.cast("string"))
    return F.struct(F.regexp_replace(text, "^﻿", "").alias("text"), charset.alias("charset"))


def request_trace(logs: DataFrame, text: str) -> DataFrame:
    """S22. Requests in log text: ord, method, url, code."""
    line = r"\b(GET|HEAD|POST)\s+(https?://\S+).{0,40}?\b([1-5]\d\d)\b"
    pick = lambda k: F.regexp_extract_all(F.col(text), F.lit(line), k)
    z = F.arrays_zip(pick(1).alias("method"), pick(2).alias("url"), pick(3).alias("code"))
    rest = [c for c in logs.columns if c != text]
    return logs.select(*rest, F.posexplode(z).alias("ord", "r")).select(*rest, "ord", F.col("r.method").alias("method"), F.col("r.url").alias("url"), F.col("r.code").cast("int").alias("code"))


def json_nodes(docs: DataFrame, key: str, body: str, wanted: str) -> DataFrame:
    """S19, S20. Elements of every array named ``wanted`` anywhere in JSON documents, as JSON text with their place."""

    def run(frames):
        import pandas as pd

        def walk(node):
            if isinstance(node, dict):
                for k, v in node.items():
                    if k == wanted and isinstance(v, list):
                        yield from v
                    yield from walk(v)
            elif isinstance(node, list):
                for v in node:
                    yield from walk(v)

        for f in frames:
            rows = []
            for k, b in zip(f[key], f[body], strict=True):
                try:
                    rows += [(k, n, json.dumps(x, sort_keys=True)) for n, x in enumerate(walk(json.loads(b)))]
                except (TypeError, ValueError):
                    continue
            yield pd.DataFrame(rows, columns=[key, "ord", "node"])

    return docs.select(key, body).mapInPandas(run, f"{key} {docs.schema[key].dataType.simpleString()}, ord int, node string")


def latest_file(spark: SparkSession, path: str) -> DataFrame:
    """S25. The newest file of a folder by name, then time: one row of path, length, modificationTime."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    return files.orderBy(F.col("path").desc(), F.col("modificationTime").desc()).limit(1)


# Fixed values.
URL_FIELDS = ["normalized_url", "raw_url", "url", "url_descarga", "download_url"]
REQUEST_FIELDS = ["requests_total", "request_count", "requests"]


def json_levels(docs: DataFrame, key: list[str], body: str, store=None) -> DataFrame:
    """S20. All nodes of JSON documents: (key, place, name, kind, raw). ``place`` is the path of positions from the root (an empty
    array), in the document's order, so ordering by it is the order of a depth-first walk; kind is OBJECT, ARRAY, STRING, BIGINT, ...;
    raw is the node's JSON text, a string's its content. Bodies that are no JSON give no rows.

    Level by level inside the JVM: each round splits the containers of the last one, for all documents at once, until
    none has members. A document's depth is the number of rounds."""
    store = store or to_shared
    kind_of = F.regexp_extract(F.schema_of_variant(F.try_parse_json("raw")), r"^\w+", 0)
    level = docs.select(*key, F.array().cast("array<int>").alias("place"), F.lit(None).cast("string").alias("name"), F.ltrim(F.col(body)).alias("raw"))
    level = level.where(F.try_parse_json("raw").isNotNull()).withColumn("kind", kind_of)
    level, out = store(level.select(*key, "place", "name", "kind", "raw")), None
    while True:
        out = level if out is None else out.union(level)
        inner = level.where("kind IN ('OBJECT', 'ARRAY')")
        object_ = lambda t: F.from_json(F.when(F.col("kind") == "OBJECT", F.col("raw")), f"map<string,{t}>")
        array = lambda t: F.from_json(F.when(F.col("kind") == "ARRAY", F.col("raw")), f"array<{t}>")
        texts = F.coalesce(F.map_values(object_("string")), array("string"))
        types = F.transform(F.coalesce(F.map_values(object_("variant")), array("variant")), lambda v: F.regexp_extract(F.schema_of_variant(v), r"^\w+", 0))
        inner = inner.select(*key, "place", F.map_keys(object_("string")).alias("names"), F.posexplode(F.arrays_zip(texts.alias("raw"), types.alias("kind"))).alias("at", "m"))
        level = inner.select(*key, F.concat("place", F.array("at")).alias("place"), F.get("names", F.col("at")).alias("name"), "m.kind", "m.raw")
        level = store(level)
        if not level.limit(1).count():
            return out


def probe_outputs(docs: DataFrame, by: str, order: str, body: str, store=None) -> DataFrame:
    """S19. Of each probe's JSON outputs: distinct resource URLs (of the items of every array named resources, the first of URL_FIELDS
    with text), the last execution_status and stop_reason in the order of documents and their walk, and the most requests
    that any node reports. Documents that are no JSON do not count; a probe with none of others has zero resources and nulls."""
    nodes = (store or to_shared)(json_levels(spread(docs, by, order), [by, order], body, store))
    parent = F.slice("place", 1, F.size("place") - 1)
    lists = nodes.where("name = 'resources' AND kind = 'ARRAY'").select(by, order, F.col("place").alias("list"))
    fields = nodes.where(F.col("name").isin(*URL_FIELDS) & (F.col("kind") == "STRING") & (F.trim("raw") != "") & (F.size("place") >= 2))
    fields = fields.select(by, order, parent.alias("item"), F.slice("place", 1, F.size("place") - 2).alias("list"), F.array_position(F.array(*map(F.lit, URL_FIELDS)), F.col("name")).alias("n"), F.trim("raw").alias("url"))
    urls = fields.join(lists, [by, order, "list"], "left_semi").groupBy(by, order, "item").agg(F.min_by("url", "n").alias("url")).groupBy(by).agg(F.countDistinct("url").alias("resources_found"))
    last = lambda name: F.max_by("raw", F.when((F.col("name") == name) & (F.col("kind") == "STRING"), F.struct(order, parent))).alias(name)
    whole = F.when(F.col("name").isin(*REQUEST_FIELDS) & (F.col("kind") == "BIGINT"), F.col("raw").try_cast("long"))
    rest = nodes.where("size(place) > 0").groupBy(by).agg(last("execution_status"), last("stop_reason"), F.max(whole).alias("requests_reported"))
    return docs.select(by).distinct().join(urls, by, "left").join(rest, by, "left").select(by, F.coalesce("resources_found", F.lit(0)).alias("resources_found"), "execution_status", "stop_reason", "requests_reported")
