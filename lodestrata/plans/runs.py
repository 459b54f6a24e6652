"""Queries of run bookkeeping, matching, audits and the catalog's own questions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import api as A
from ..operators import audit, catalog, packages, resolution, state
from ..sources import sinks
from .catalog import _HEALTH
from .registry import query
from .views import RESOURCES, RUNS, resources, runs, table


def _catalog(spark, sf_dir) -> catalog.Catalog:
    """The catalog's tables: resources by year of capture, nations as sources, runs as observations, orders as reports."""
    r = resources(spark, sf_dir).withColumn("captured_at", F.col("yyyy"))
    n = table(spark, sf_dir, "nation").select(F.lower(F.replace("n_name", F.lit(" "), F.lit("_"))).alias("source_id"), "n_regionkey")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderdate").alias("finished_at"), "o_totalprice")
    return catalog.Catalog(r, n, runs(spark, sf_dir).select(F.col("source_id").cast("string").alias("source_id"), F.col("ts").alias("observed_at"), "run_id", "status"), o)


@query(f"SELECT k, r.source_id, resource_key FROM ({RESOURCES}) r JOIN (SELECT source_id, max(yyyy) AS y FROM ({RESOURCES}) GROUP BY 1) m ON m.source_id = r.source_id AND m.y = r.yyyy")
def catalog_resources(spark, sf_dir):
    """O01."""
    return _catalog(spark, sf_dir).resources().select("k", "source_id", "resource_key")


@query(f"SELECT k, resource_key FROM ({RESOURCES}) WHERE source_id = 'nation_1' AND yyyy = (SELECT max(yyyy) FROM ({RESOURCES}) WHERE source_id = 'nation_1')")
def catalog_resources_of_source(spark, sf_dir):
    """O01 with its filter."""
    return _catalog(spark, sf_dir).resources("nation_1").select("k", "resource_key")


@query("SELECT lower(replace(n_name, ' ', '_')) AS source_id, n_regionkey, n_name = 'NATION_1' AS asked FROM nation")
def catalog_sources(spark, sf_dir):
    """O02, O03."""
    c = _catalog(spark, sf_dir)
    return c.sources().join(c.source("nation_1").select("source_id", F.lit(True).alias("asked")), "source_id", "left").select("source_id", "n_regionkey", F.coalesce("asked", F.lit(False)).alias("asked"))


@query("SELECT o_orderkey::VARCHAR AS run_id, o_totalprice FROM (SELECT * FROM orders ORDER BY o_orderdate DESC, o_orderkey::VARCHAR LIMIT 20) UNION ALL SELECT o_orderkey::VARCHAR, o_totalprice FROM orders WHERE o_orderkey = (SELECT min(o_orderkey) FROM orders)")
def catalog_runs(spark, sf_dir):
    """O04, and O05 of the first run."""
    c = _catalog(spark, sf_dir)
    first = table(spark, sf_dir, "orders").agg(F.min("o_orderkey")).first()[0]
    return c.runs(20).select("run_id", "o_totalprice").union(c.report(str(first)).select("run_id", "o_totalprice"))


@query(f"SELECT run_id, status FROM (SELECT *, row_number() OVER (ORDER BY ts DESC, run_id) AS rn FROM ({RUNS}) WHERE source_id = 7) WHERE rn <= 20")
def catalog_observations(spark, sf_dir):
    """O06."""
    return _catalog(spark, sf_dir).observations("7").select("run_id", "status")


@query(f"""SELECT source_id, yyyy, max(total) AS total, lag(max(total)) OVER (PARTITION BY source_id ORDER BY yyyy) AS previous_total FROM (SELECT source_id, yyyy, count(*) AS total FROM ({RESOURCES}) GROUP BY 1, 2) GROUP BY 1, 2""")
def previous_snapshots(spark, sf_dir):
    """J02."""
    s = resources(spark, sf_dir).groupBy("source_id", "yyyy").agg(F.count("*").alias("total"))
    return catalog.previous_snapshot(s, "source_id", "yyyy", ["total"])


@query(f"""WITH h AS ({_HEALTH}), c AS (SELECT source_id, run_id, ts, status, unchanged, CASE WHEN unchanged >= 8 THEN 'MONTHLY' WHEN unchanged >= 7 THEN 'WEEKLY' ELSE 'DAILY' END AS cadence FROM (
SELECT *, sum((status = 'NO_CHANGE')::INT) OVER (PARTITION BY source_id, epoch ORDER BY ts, run_id)::BIGINT AS unchanged FROM (SELECT *, sum((status = 'CHANGED')::INT) OVER (PARTITION BY source_id ORDER BY ts, run_id) AS epoch FROM ({RUNS}))))
SELECT source_id, run_id, health, cadence, CASE WHEN status <> 'FAILED' THEN ts + to_days(CASE cadence WHEN 'DAILY' THEN 1 WHEN 'WEEKLY' THEN 7 ELSE 30 END) WHEN health <> 'SUSPENDED' THEN ts + INTERVAL 4 HOURS END AS next_eligible_at FROM c JOIN h USING (source_id, run_id)""")
def run_outcomes(spark, sf_dir):
    """G11."""
    return state.after_run(runs(spark, sf_dir)).select("source_id", "run_id", "health", "cadence", "next_eligible_at")


_CHECKPOINT = "SELECT event_id AS source_id, CASE event_type WHEN 'view' THEN 'PENDING' WHEN 'click' THEN 'RUNNING' WHEN 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS state FROM events"


@query(f"SELECT source_id, CASE state WHEN 'RUNNING' THEN 'FAILED' ELSE state END AS state FROM ({_CHECKPOINT}) WHERE state <> 'SUCCEEDED'")
def resume_candidates(spark, sf_dir):
    """G13, F69."""
    e = table(spark, sf_dir, "events").selectExpr("event_id AS source_id", "CASE event_type WHEN 'view' THEN 'PENDING' WHEN 'click' THEN 'RUNNING' WHEN 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS state")
    return state.resumable(state.recover(e))


@query("SELECT c_custkey AS source_id, CASE WHEN c_nationkey % 2 = 0 THEN 'PENDING' ELSE 'SKIPPED_STATUS' END AS state, 0 AS attempts, coalesce(n, 0) AS saved FROM customer LEFT JOIN (SELECT o_custkey, count(*)::INT AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON o_custkey = c_custkey")
def checkpoint_from_plan(spark, sf_dir):
    """G14, Z37."""
    plan = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source_id"), F.when(F.col("c_nationkey") % 2 == 0, "OPERATIONAL_CONFIG").otherwise("B10_STATUS").alias("next_phase"))
    saved = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("source_id")).agg(F.count("*").cast("int").alias("attempts")).withColumn("state", F.lit("FAILED"))
    return resolution.new_checkpoint(plan).join(packages.remediation_state(plan, saved).select("source_id", F.col("attempts").alias("saved")), "source_id")


@query("""WITH c AS (SELECT o_custkey AS run_id, o_orderkey AS source_id, CASE o_orderkey % 4 WHEN 0 THEN 'SUCCEEDED' WHEN 1 THEN 'RUNNING' ELSE 'PENDING' END AS state, o_orderkey % 5 <> 0 AS ok FROM orders),
d AS (SELECT *, state <> 'SUCCEEDED' AS due, sum((state <> 'SUCCEEDED')::INT) OVER w AS n, coalesce(sum((state <> 'SUCCEEDED' AND NOT ok)::INT) OVER (PARTITION BY run_id ORDER BY source_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS f FROM c WINDOW w AS (PARTITION BY run_id ORDER BY source_id))
SELECT run_id, source_id, CASE WHEN due AND n <= 6 AND f = 0 THEN CASE WHEN ok THEN 'SUCCEEDED' ELSE 'FAILED' END WHEN state = 'RUNNING' THEN 'FAILED' ELSE state END AS state, (due AND n <= 6 AND f = 0)::INT AS attempts FROM d""")
def checkpointed_pass(spark, sf_dir):
    """G15."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run_id"), k.alias("source_id"), k.alias("ord"), F.when(k % 4 == 0, "SUCCEEDED").when(k % 4 == 1, "RUNNING").otherwise("PENDING").alias("state"), F.lit(0).alias("attempts"))
    outcomes = o.where("source_id % 5 <> 0").select("run_id", "source_id", F.lit(True).alias("ok"))
    return state.run_pass(o, outcomes, most=6, fail_fast=True).select("run_id", "source_id", "state", "attempts")


@query("""SELECT c_custkey AS source_id, CASE WHEN c_nationkey < 20 AND n = 0 THEN 'MISSING' WHEN c_nationkey < 20 AND n > 1 THEN 'AMBIGUOUS' WHEN c_nationkey >= 20 AND n > 0 THEN 'UNEXPECTED' ELSE 'OK' END AS outcome
FROM (SELECT c_custkey, c_nationkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT') AS n FROM customer)""")
def mapping_outcomes(spark, sf_dir):
    """J05, Z24."""
    plan = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source_id"), (F.col("c_nationkey") < 20).alias("operational"))
    return resolution.mapping_report(plan, table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("source_id")))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'a' ELSE 'b' END || c_custkey AS report FROM orders JOIN customer ON c_custkey = o_custkey")
def report_fallback(spark, sf_dir):
    """The run's own report, else the source's latest."""
    c = table(spark, sf_dir, "customer")
    one = lambda run, at, tag: c.select(F.col("c_custkey").alias("source_id"), F.lit(run).alias("run_id"), F.lit(at).alias("at"), F.concat(F.lit(tag), F.col("c_custkey").cast("string")).alias("report"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("source_id"), (F.col("o_orderkey") % 5).cast("int").alias("run_id"))
    return resolution.with_fallback(o, "run_id", one(0, 1, "a").union(one(3, 2, "b")), "at", ["report"]).select("o_orderkey", "report")


@query("SELECT s_suppkey AS logical_id, n_name AS result FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def logical_fan_out(spark, sf_dir):
    """J11, J12, Z41."""
    site = lambda key, end: F.concat(F.lit("https://n"), F.col(key).cast("string"), F.lit(".org" + end))
    logical = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("logical_id"), site("s_nationkey", "//").alias("entrypoint"))
    physical = table(spark, sf_dir, "nation").select(F.col("n_name").alias("source_id"), site("n_nationkey", "/").alias("entrypoint"), F.col("n_name").alias("result"))
    return resolution.fan_out(logical, physical).select("logical_id", "result")


@query("""WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'p' || c_nationkey END AS physical, 'https://' || (c_custkey % 40) || '.org' AS entry, c_mktsegment AS workflow FROM customer)
SELECT CASE WHEN physical = '' THEN entry ELSE physical END AS group_key, min(c_custkey)::VARCHAR AS representative, count(DISTINCT entry) = 1 AS one_entrypoint, count(DISTINCT workflow) = 1 AS one_workflow, count(DISTINCT entry) AS seeds FROM c GROUP BY 1""")
def config_groups(spark, sf_dir):
    """A21, Z60, Z61."""
    c = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("logical_id"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.concat(F.lit("p"), F.col("c_nationkey").cast("string"))).alias("physical_id"),
        F.concat(F.lit("https://"), (F.col("c_custkey") % 40).cast("string"), F.lit(".org")).alias("entrypoint"), F.col("c_custkey").alias("ord"), F.col("c_mktsegment").alias("workflow"),
    )
    g = resolution.groups_of_config(c)
    return g.select("group_key", "representative", "one_entrypoint", "one_workflow", F.size(F.split("seeds", ",")).cast("long").alias("seeds"))


@query(f"SELECT 'method:' || ext AS kind, count(DISTINCT topic || yyyy) AS urls FROM ({RESOURCES}) GROUP BY 1 UNION ALL SELECT 'type:file', count(DISTINCT topic || yyyy) FROM ({RESOURCES})")
def evidence_method_counts(spark, sf_dir):
    """A14, A29."""
    r = resources(spark, sf_dir).select(F.concat("topic", "yyyy").alias("url"), F.col("ext").alias("discovery_method"), "resource_type")
    return resolution.evidence_counts(r)


_CLASSES = "['DATAX_READY', 'EXTERNAL_BLOCKER', 'ACQUISITION_JOB_READY', CASE n_nationkey % 5 WHEN 1 THEN 'PENDING' ELSE 'DATAX_READY' END, CASE n_nationkey % 4 WHEN 1 THEN 'PROJECTION_EMPTY' ELSE 'EXTERNAL_BLOCKER' END]"


@query(f"""WITH c AS (SELECT c_nationkey, {_CLASSES.replace('n_nationkey', 'c_nationkey')}[c_custkey % 5 + 1] AS class FROM customer)
SELECT n_nationkey, count(class) FILTER (class = 'PENDING') AS pending, count(class) FILTER (class = 'PROJECTION_EMPTY') AS unresolved,
CASE WHEN count(class) FILTER (class = 'PENDING') > 0 THEN 'PARTIAL' WHEN count(class) FILTER (class = 'PROJECTION_EMPTY') > 0 THEN 'FAILED' WHEN n_nationkey % 3 = 0 THEN 'PACKAGE_NOT_BUILT' WHEN n_nationkey % 3 = 1 THEN 'PACKAGE_REVIEW' ELSE 'READY' END AS state,
count(class) FILTER (class = 'DATAX_READY') = count(class) AND count(class) = 60 AS ready FROM nation LEFT JOIN c ON c_nationkey = n_nationkey WHERE n_nationkey < 8 GROUP BY 1""")
def pipeline_states(spark, sf_dir):
    """A32, F78, for the customers of each of eight nations."""
    c, out = table(spark, sf_dir, "customer"), None
    for n in range(8):
        rows = c.where(F.col("c_nationkey") == n).select(F.expr(_CLASSES.replace("[", "array(").replace("]", ")").replace("n_nationkey", str(n)))[(F.col("c_custkey") % 5).cast("int")].alias("classification"))
        package = table(spark, sf_dir, "nation").where(f"n_nationkey = {n} AND {n % 3} > 0").select(F.lit(n % 3 == 2).alias("package_ready"))
        one = resolution.pipeline_state(rows, package).join(F.broadcast(resolution.package_ready(rows, 60, ["DATAX_READY"]))).select(F.lit(n).cast("long").alias("n_nationkey"), "pending", "unresolved", "state", "ready")
        out = one if out is None else out.union(one)
    return out


@query("SELECT c_custkey AS source_id FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS s, arg_max(o_orderpriority, o_orderkey) AS p FROM orders GROUP BY 1) ON o_custkey = c_custkey WHERE s IS NULL OR s <> 'O' OR p = '1-URGENT'")
def remediation_candidates(spark, sf_dir):
    """F71."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("source_id")).agg(F.max_by("o_orderstatus", "o_orderkey").alias("s"), F.max_by("o_orderpriority", "o_orderkey").alias("p"))
    reports = o.select("source_id", F.when(F.col("s") == "O", "SUCCESS").otherwise("FAILED").alias("execution_status"), F.when(F.col("p") == "1-URGENT", "EMPTY_RESULT").otherwise("CHANGED").alias("content_status"))
    return resolution.remediation(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source_id")), reports)


@query("SELECT o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1) WHERE place <= 3")
def capped_identities(spark, sf_dir):
    """W07, H06, T06, Z12."""
    return resolution.capped(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", "o_orderkey", 3).select("o_orderkey")


@query("SELECT o_custkey, arg_min(o_orderkey, o_orderkey) AS first_order, arg_min(o_orderpriority, o_orderkey) AS priority FROM orders GROUP BY 1")
def first_arrivals(spark, sf_dir):
    """W13."""
    from ..operators.frontier import first_seen

    return first_seen(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderkey"]).select("o_custkey", F.col("o_orderkey").alias("first_order"), F.col("o_orderpriority").alias("priority"))


@query("SELECT o_custkey AS source_id, coalesce(arg_min(o_orderpriority, o_orderkey) FILTER (o_orderkey % 7 = 0), arg_max(o_orderpriority, o_orderkey)) AS stage, max((o_orderkey % 7 = 0)::INT) AS resources FROM orders GROUP BY 1")
def first_successful_stage(spark, sf_dir):
    """W11, G21, Z42."""
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("source_id"), F.col("o_orderpriority").alias("stage"), F.col("o_orderkey").alias("o"), (F.col("o_orderkey") % 7 == 0).cast("int").alias("resources"))
    return resolution.first_success(o, "source_id", "o")


@query("""WITH p AS (SELECT o_custkey AS c, o_orderkey AS o, o_orderkey % 23 AS u, o_orderkey % 31 AS h, o_orderstatus = 'P' AS f, o_orderkey % 3 AS r FROM orders),
w AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY o) AS n, sum(r) OVER (PARTITION BY c ORDER BY o) AS total, row_number() OVER (PARTITION BY c, u ORDER BY o) AS un, row_number() OVER (PARTITION BY c, h ORDER BY o) AS hn, first(f) OVER (PARTITION BY c ORDER BY o) AS f0, sum(r) OVER (PARTITION BY c ORDER BY o ROWS 1 PRECEDING) AS recent FROM p),
s AS (SELECT *, CASE WHEN un > 1 THEN 'REPEATED_URL' WHEN f <> f0 THEN 'FORMAT_CHANGED' WHEN hn > 1 THEN 'REPEATED_PAYLOAD' WHEN n > 2 AND recent = 0 THEN 'STAGNANT' WHEN n >= 5 THEN 'MAX_PAGES' WHEN total >= 5000 THEN 'MAX_RECORDS' END AS rule FROM w)
SELECT c, o, first(rule IGNORE NULLS) OVER (PARTITION BY c ORDER BY o) AS stop_reason FROM s""")
def pagination_stops(spark, sf_dir):
    """G05."""
    o = table(spark, sf_dir, "orders").selectExpr("o_custkey AS c", "o_orderkey AS o", "cast(o_orderkey % 23 as string) AS url", "cast(o_orderkey % 31 as string) AS page_hash", "o_orderstatus = 'P' AS format", "o_orderkey % 3 AS records")
    return resolution.pagination_chain(o, "c", "o").select("c", "o", "stop_reason")


@query("""WITH a AS (SELECT * FROM (SELECT o_custkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, [200, 429, 503, NULL, 429][o_orderkey % 5 + 1] AS status FROM orders) WHERE n <= 3), r AS (SELECT *, status IS NULL OR status IN (429, 503) AS again FROM a)
SELECT k, CASE WHEN bool_or(NOT again) THEN arg_min(status, n) FILTER (NOT again) ELSE max(status) FILTER (n = last) END AS status, coalesce(min(n) FILTER (NOT again), max(n))::INT AS attempts FROM (SELECT *, max(n) OVER (PARTITION BY k) AS last FROM r) GROUP BY 1""")
def final_attempts(spark, sf_dir):
    """G20."""
    status = F.element_at(F.array(F.lit(200), F.lit(429), F.lit(503), F.lit(None).cast("int"), F.lit(429)), (F.col("o_orderkey") % 5 + 1).cast("int"))
    attempt = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    return resolution.final_attempt(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), attempt.alias("attempt"), status.alias("status")), "k", [429, 503])


@query("""WITH r AS (SELECT event_id, user_id % 7 AS host, floor(epoch(ts)) AS due, (user_id % 7) * 10.0 AS gap, row_number() OVER (PARTITION BY user_id % 7 ORDER BY floor(epoch(ts)), event_id) AS n FROM events)
SELECT event_id, max(due - gap * n) OVER (PARTITION BY host ORDER BY n) + gap * n AS start_s FROM r""")
def host_schedules(spark, sf_dir):
    """G19, Z06."""
    e = table(spark, sf_dir, "events").select("event_id", (F.col("user_id") % 7).alias("host"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).cast("double").alias("at_s"))
    gaps = e.select("host", (F.col("host") * 10.0).alias("interval_s")).union(e.select("host", (F.col("host") * 4.0).alias("interval_s"))).distinct()
    return resolution.host_schedule(e, "event_id", gaps).select("event_id", "start_s")


@query("SELECT user_id AS url, arg_max('e' || event_id, event_id) FILTER (event_type IN ('view', 'click')) AS etag, arg_max('m' || event_id, event_id) FILTER (event_type <> 'view') AS last_modified FROM events GROUP BY 1")
def conditional_cache(spark, sf_dir):
    """G17."""
    tag = lambda t: F.concat(F.lit(t), F.col("event_id").cast("string"))
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("url"), "event_id", F.when(F.col("event_type").isin("view", "click"), tag("e")).alias("etag"), F.when(F.col("event_type") != "view", tag("m")).alias("last_modified"))
    return resolution.conditional_headers(e, "event_id")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def slowest_runs(spark, sf_dir):
    """T01, T03."""
    return resolution.slowest(table(spark, sf_dir, "orders"), "o_totalprice", "o_orderkey").select("o_orderkey", "o_totalprice")


@query("SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def repeated_keys(spark, sf_dir):
    """J22."""
    return catalog.unique_key(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), "k")


@query("""SELECT name, ok FROM (SELECT count(*) AS n, count(DISTINCT o_custkey) AS c, max(o_totalprice) AS m FROM orders), LATERAL (SELECT unnest(['rows', 'customers', 'prices', 'unknown']) AS name, unnest([n > 0, c <= n, m < 0, false]) AS ok)""")
def closure_checks(spark, sf_dir):
    """A31, A33, A34, A35, Z47, Z51."""
    row = table(spark, sf_dir, "orders").agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("c"), F.max("o_totalprice").alias("m"))
    return audit.checks(row, {"rows": F.col("n") > 0, "customers": F.col("c") <= F.col("n"), "prices": F.col("m") < 0, "unknown": F.lit(None).cast("boolean")})


@query("""SELECT o_custkey, sha256('api-sample-v1|json|' || count(*) || '|' || string_agg(rn || ':' || sha256('{"a":' || o_orderkey || ',"b":[1]}'), '|' ORDER BY rn)) AS sample_hash FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) GROUP BY 1""")
def api_sample_hashes(spark, sf_dir):
    """A08, X09."""
    body = F.concat(F.lit('{"b": [1], "a": '), F.col("o_orderkey").cast("string"), F.lit("}"))
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.lit("json").alias("format"), body.alias("body"))
    return A.sample_hash(o.withColumn("digest", A.page_hash(F.col("body"), F.col("format"))), ["o_custkey"], "o_orderkey", "digest", "format")


@query("""SELECT user_id, bool_or(event_type = 'view') AS is_openapi, bool_or(value > 100) AS has_pagination, bool_and(event_type <> 'error') AS callable_by_policy, arg_min(event_type, event_id) FILTER (event_type <> 'click') AS format,
arg_min('d' || event_id, event_id) FILTER (event_type = 'error') AS documentation_url, arg_min('u' || event_id, (event_type <> 'view', event_type = 'click', event_id)) AS url FROM events GROUP BY 1""")
def api_merges(spark, sf_dir):
    """A09, A10."""
    e = table(spark, sf_dir, "events").select(
        "user_id", "event_id", (F.col("event_type") == "view").alias("is_openapi"), (F.col("value") > 100).alias("has_pagination"), (F.col("event_type") != "error").alias("callable_by_policy"),
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("format"), F.when(F.col("event_type") == "error", F.concat(F.lit("d"), F.col("event_id").cast("string"))).alias("documentation_url"), F.concat(F.lit("u"), F.col("event_id").cast("string")).alias("url"),
    )
    return A.merge_api(e, "user_id", "event_id")


@query("SELECT p_partkey::VARCHAR AS path, sha256(p_name) AS sha256, (1 + (p_partkey % 10 = 0)::INT)::BIGINT AS n FROM part")
def checksum_lines(spark, sf_dir):
    """Z46."""
    p = table(spark, sf_dir, "part").select(F.concat_ws("  ", F.sha2("p_name", 256), F.col("p_partkey").cast("string")).alias("value"), "p_partkey")
    return sinks.parse_checksums(p.select("value").union(p.where("p_partkey % 10 = 0").select("value")))


@query("""SELECT sha256(string_agg('{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || '}', chr(10) ORDER BY n_nationkey)) AS fingerprint FROM nation""")
def plan_fingerprint(spark, sf_dir):
    """A26, D08."""
    return sinks.fingerprint(table(spark, sf_dir, "nation"), ["n_name", "n_nationkey"], ["n_nationkey"])


@query(f"SELECT source_id, count(*) AS resources, count(*) FILTER (k % 2 = 0) AS apis, CASE WHEN source_id LIKE '%3' THEN 'FAILED' ELSE 'SUCCESS' END AS state, CASE WHEN source_id LIKE '%3' THEN 'EXECUTION_NOT_SUCCESS' WHEN source_id LIKE '%2' THEN 'DATAX_READY' ELSE 'RAW_READY_NO_PROJECTION' END AS classification FROM ({RESOURCES}) GROUP BY 1")
def audit_rows(spark, sf_dir):
    """Z18, Z58, Z69, Z71."""
    r = resources(spark, sf_dir).select("source_id", F.when(F.col("k") % 2 == 0, "api").otherwise("file").alias("resource_type"))
    ids = r.select("source_id").distinct()
    legacy = ids.where("source_id LIKE '%2'").select("source_id", F.lit(2).cast("long").alias("valid"), F.lit(0).cast("long").alias("invalid"))
    states = ids.select("source_id", F.when(F.col("source_id").endswith("3"), "FAILED").otherwise("SUCCESS").alias("state"))
    return packages.audit_row(r, legacy, states).select("source_id", "resources", "apis", "state", "classification")
