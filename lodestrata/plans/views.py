"""Catalog-shaped views derived from the tables, in Spark and in DuckDB's SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U
from ..operators import projection
from ..sources.shared import spread

EXT = ["csv", "xlsx", "ods", "json", "pdf", "docx", "zip", ""]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A place in the cluster's shared folder, ``spark.checkpoint.dir``. Where that is unset, a folder of this machine serves
    a session that runs on this machine alone; on a cluster it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(base or '/tmp/checkpoints').rstrip('/')}/{name}"


_stored: dict[tuple, str] = {}


def _stamps(spark: SparkSession, sf_dir: str, tables: tuple[str, ...] = ("orders", "customer", "nation")) -> tuple:
    """Times and sizes of the input tables' files: what is stored of them is stale once these change."""
    out = []
    for t in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        out.append((status.getModificationTime(), status.getLen()))
    return tuple(out)


def stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A catalog table, written once in an application for each state of the input folder and read from there by later stages:
    their filters then reach the Parquet scan instead of being inlined into the expressions that made the columns."""
    key = (spark.sparkContext.applicationId, sf_dir, name, _stamps(spark, sf_dir))
    if key not in _stored:
        path = shared_path(spark, f"catalog-{uuid.uuid4().hex}/{name}")
        build().write.parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resource candidates of two snapshots: one per order, by customer nation and order priority."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    o = spread(o, "o_orderkey")
    ext = F.element_at(F.array(*[F.lit(e) for e in EXT]), (F.col("o_orderkey") % 8).cast("int") + 1)
    rows = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    rows = rows.select(
        F.col("o_orderkey").alias("k"),
        F.lower(F.replace("n_name", F.lit(" "), F.lit("_"))).alias("source_id"),
        F.replace(F.lower(F.expr("substr(o_orderpriority, 3)")), F.lit(" "), F.lit("-")).alias("topic"),
        F.date_format("o_orderdate", "MM").alias("mm"),
        F.date_format("o_orderdate", "yyyy").alias("yyyy"),
        ext.alias("ext"),
    )
    name = F.concat_ws("_", "topic", "mm", "yyyy")
    file = F.when(F.col("ext") == "", name).otherwise(F.concat(name, F.lit("."), F.col("ext")))
    return rows.withColumns(
        {
            "title": F.concat_ws(" ", "topic", "mm", "yyyy"),
            "url": F.concat(F.lit("https://www."), F.col("source_id"), F.lit(".example.org/"), F.col("topic"), F.lit("/"), file, F.lit("?utm_source=x&id="), F.col("k").cast("string")),
        }
    )


CANDIDATES = f"""
SELECT o_orderkey AS k, lower(replace(n_name, ' ', '_')) AS source_id, replace(lower(substr(o_orderpriority, 3)), ' ', '-') AS topic,
  strftime(o_orderdate, '%m') AS mm, strftime(o_orderdate, '%Y') AS yyyy, {EXT!r}[o_orderkey % 8 + 1] AS ext,
  topic || ' ' || mm || ' ' || yyyy AS title,
  'https://www.' || source_id || '.example.org/' || topic || '/' || topic || '_' || mm || '_' || yyyy
    || CASE WHEN ext = '' THEN '' ELSE '.' || ext END AS bare,
  bare || '?utm_source=x&id=' || o_orderkey AS url, bare || '?id=' || o_orderkey AS nurl
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "resources", lambda: build_resources(spark, sf_dir))


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "decisions", lambda: projection.decide(resources(spark, sf_dir)))


def build_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P01 over the candidates: normal URL, extension, effective title, period, identity, evidence."""
    c = candidates(spark, sf_dir).withColumn("nurl", U.normalize(F.col("url")))
    return c.withColumns(
        {
            "resource_key": U.resource_key(F.col("source_id"), F.col("nurl")),
            "file_extension": U.extension(F.col("nurl")),
            "resource_type": F.lit("file"),
            "period_label": T.period(F.lit(None).cast("string"), F.col("title"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("nurl")),
            "etag": F.when(F.col("k") % 9 == 0, "").otherwise(F.concat(F.lit("e"), (F.col("k") % 100).cast("string"))),
        }
    )


RESOURCES = f"""
SELECT *, sha256(source_id || '|' || nurl) AS resource_key, CASE WHEN ext = '' THEN '' ELSE '.' || ext END AS file_extension,
  yyyy || '-' || mm AS period_label, CASE WHEN k % 9 = 0 THEN '' ELSE 'e' || (k % 100) END AS etag
FROM ({CANDIDATES})
"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source runs: an event of a user is a run of a source."""
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type").isin("purchase", "signup"), "CHANGED").otherwise("NO_CHANGE")
    return e.select(F.col("user_id").alias("source_id"), "ts", F.col("event_id").alias("run_id"), "event_type", "value", status.alias("status"), (F.col("event_type") == "purchase").cast("int").alias("new_resources"))


RUNS = """
SELECT user_id AS source_id, ts, event_id AS run_id, event_type, value, (event_type = 'purchase')::INT AS new_resources,
  CASE WHEN event_type = 'error' THEN 'FAILED' WHEN event_type IN ('purchase', 'signup') THEN 'CHANGED' ELSE 'NO_CHANGE' END AS status
FROM events
"""
