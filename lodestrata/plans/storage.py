"""Registered queries of stored tables and packages."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources import artifacts, files
from ..sources.keyed import KeyedTable
from ..sources.package import build_package, verify_package
from . import catalog
from .registry import query
from .views import shared_path, table


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts FROM events GROUP BY 1")
def keyed_upserts(spark, sf_dir):
    """Events in six batches, the latest of each user; one batch is replayed, the last touches few buckets."""
    t = KeyedTable(spark, shared_path(spark, f"keyed-{uuid.uuid4().hex}"), ["user_id"], ["ts", "event_id"], "user_id long, event_id long, event_type string, ts timestamp_ntz", buckets=16, pieces=3)
    e = table(spark, sf_dir, "events")
    for k in (0, 1, 2, 1, 3, 4, 5):
        t.upsert(e.where(F.pmod(F.xxhash64("event_id"), F.lit(6)) == k), f"batch-{k}")
    return t.read()


_LINE = """'{"k":' || o_orderkey || ',"p":"' || o_orderpriority || '"}'"""


@query(f"""WITH o AS (SELECT 'n' || c_nationkey AS source_id, o_orderkey, {_LINE} AS line, (row_number() OVER (PARTITION BY c_nationkey ORDER BY o_orderkey) - 1) // 400 AS part FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT 'sources/' || source_id || '/part-' || lpad(part::VARCHAR, 5, '0') || '.jsonl' AS path, source_id, count(*) AS records, sha256(string_agg(line || chr(10), '' ORDER BY o_orderkey)) AS sha256, true AS matches FROM o GROUP BY source_id, part""")
def package_build(spark, sf_dir):
    """Orders by customer nation; digests of the manifest against those of the files as they lie."""
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    path = shared_path(spark, f"package-{uuid.uuid4().hex}")
    entries = build_package(o.withColumn("source", F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))), path, "source", ["o_orderkey"], F.to_json(F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("p"))), 400)
    return verify_package(entries, path).select("path", "source_id", "records", "sha256", "matches")


_PROBES = """WITH o AS (SELECT o_custkey % 50 AS source_id, o_orderkey AS k FROM orders WHERE o_orderkey % 13 > 0),
u AS (SELECT source_id, 'https://a.org/' || k % 40 AS url FROM o UNION ALL SELECT source_id, 'https://b.org/' || k % 7 FROM o WHERE k % 3 = 0)"""


@query(f"""{_PROBES} SELECT s.source_id, coalesce(n, 0) AS resources_found, status AS execution_status, stop AS stop_reason, most AS requests_reported FROM (SELECT DISTINCT o_custkey % 50 AS source_id FROM orders) s
LEFT JOIN (SELECT source_id, count(DISTINCT url) AS n FROM u GROUP BY 1) n ON n.source_id = s.source_id
LEFT JOIN (SELECT source_id, arg_max(CASE WHEN k % 2 = 0 THEN 'deep' ELSE 'SUCCESS' END, k) AS status, arg_max('STOP' || k % 5, k) FILTER (k % 4 > 0) AS stop, max(k % 100) AS most FROM o GROUP BY 1) l ON l.source_id = s.source_id""")
def probe_outputs(spark, sf_dir):
    """S19, S20, by levels inside the JVM: a report of each order, some of them broken."""
    o = table(spark, sf_dir, "orders").selectExpr("o_custkey % 50 AS source_id", "o_orderkey AS k")
    body = F.expr("""CASE WHEN k % 13 = 0 THEN '{"resources": [' ELSE concat('{"execution_status": "SUCCESS", "resources": [{"url": " ", "download_url": " https://a.org/', k % 40, '"}, 7, {"url": 5}], "z": [{"requests": ', k % 100, ', "requests_total": true}, [{"a": {',
      CASE WHEN k % 3 = 0 THEN concat('"resources": [{"url": "no", "normalized_url": "https://b.org/', k % 7, '"}],') ELSE '"resources": {"url": "https://c.org"},' END, CASE WHEN k % 2 = 0 THEN '"execution_status": "deep",' ELSE '' END, '"stop_reason": ', CASE WHEN k % 4 = 0 THEN 'null' ELSE concat('"STOP', k % 5, '"') END, '}}]]}') END""")
    return files.probe_outputs(o.select("source_id", "k", body.alias("body")), "source_id", "k", "body")


@query("SELECT 'n' || n_nationkey || CASE n_nationkey % 3 WHEN 0 THEN '.log' WHEN 1 THEN '.JSON' ELSE '.txt' END AS name, CASE n_nationkey % 3 WHEN 0 THEN '.log' ELSE '.json' END AS suffix, n_name || ' é' AS text, CASE n_nationkey % 3 WHEN 0 THEN 'UTF-8' ELSE 'UTF-16LE' END AS charset, CASE n_nationkey % 3 WHEN 0 THEN strlen(n_name || ' é') ELSE 2 * length(n_name || ' é') + 2 END AS length FROM nation WHERE n_nationkey % 3 < 2 AND length(n_name) > 2")
def artifact_texts(spark, sf_dir):
    """Files of nations in two encodings, those of other suffixes and short ones filtered before they are opened."""
    from ..sources.package import filesystem

    path = shared_path(spark, f"artifacts-{uuid.uuid4().hex}")
    fs, root = filesystem(path)
    fs.create_dir(f"{root}/a/.hidden", recursive=True)
    for r in table(spark, sf_dir, "nation").select("n_nationkey", "n_name").collect():  # 25 rows
        k, text = r.n_nationkey % 3, f"{r.n_name} é"
        data = text.encode() if k != 1 else b"\xff\xfe" + text.encode("utf-16-le")
        for place in ("a", "a/.hidden"):
            with fs.open_output_stream(f"{root}/{place}/n{r.n_nationkey}{('.log', '.JSON', '.txt')[k]}") as f:
                f.write(data)
    return artifacts.artifact_texts(spark, path).where("suffix IN ('.log', '.json') AND length > 5").select("name", "suffix", "text", "charset", "length")


@query(catalog.SQL["cadence_state"])
def streaming_cadence(spark, sf_dir):
    """G10 as a stream with timers, over the events read as one available batch."""
    from ..streaming import cadence

    base = shared_path(spark, f"stream-{uuid.uuid4().hex}")
    cadence.run_available(spark, cadence.event_runs(spark, f"{sf_dir}/events.parquet"), f"{base}/state", f"{base}/out")
    return spark.read.parquet(f"{base}/out").where("kind = 'RUN'").select("source_id", "run_id", "unchanged", "cadence", "next_eligible_at")
