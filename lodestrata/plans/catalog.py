"""Registered queries over the tables, each with the DuckDB SQL of the same result where SQL can express it."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import api as A
from ..functions import html as H
from ..functions import text as T
from ..functions import urls as U
from ..operators import audit, catalog, frontier, projection, state
from ..sources import files, sinks
from .registry import QUERIES, SQL, query  # noqa: F401
from .views import CANDIDATES, RESOURCES, RUNS, build_resources, candidates, decisions, resources, runs, shared_path, table

_ORIGIN = "regexp_extract(url, '^([a-z]+://[^/?#]+)', 1)"
_HOST = "regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)"
_PATH = "regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1)"
_QUERY = r"regexp_extract(url, '\?([^#]*)', 1)"
_NAMES = "(" + ", ".join(f"'{x}'" for x in U.TRACKING) + ")"
_PAGED = "(" + ", ".join(f"'{x}'" for x in U.PAGINATION_FAMILY) + ")"
_KEPT = f"array_to_string(list_sort(list_filter(string_split({_QUERY}, '&'), lambda p: p <> '' AND lower(split_part(p, '=', 1)) NOT IN {_NAMES})), '&')"
_NORMAL = f"{_ORIGIN} || CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END || CASE WHEN {_KEPT} = '' THEN '' ELSE '?' || {_KEPT} END"


@query(f"SELECT page_id, {_NORMAL} AS url, regexp_replace({_HOST}, '^www\\.', '') AS host, sha256({_NORMAL}) AS url_hash, sha256('pages|' || {_NORMAL}) AS resource_key FROM pages")
def url_normalize(spark, sf_dir):
    """F01, F02, F03, F08."""
    n = U.normalize(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", n.alias("url"), U.canonical_host(F.col("url")).alias("host"), U.url_hash(n).alias("url_hash"), U.resource_key(F.lit("pages"), n).alias("resource_key"))


@query(f"WITH p AS (SELECT regexp_replace({_HOST}, '^www\\.', '') AS host, page_id FROM pages), s AS (SELECT DISTINCT host FROM p WHERE page_id % 3 = 0) SELECT p.host, count(*) AS n, (s.host IS NOT NULL) AS in_scope FROM p LEFT JOIN s ON p.host = s.host GROUP BY p.host, s.host")
def host_scope_counts(spark, sf_dir):
    """F53, Z07."""
    p = table(spark, sf_dir, "pages").select(U.canonical_host(F.col("url")).alias("host"), "page_id")
    scope = p.where("page_id % 3 = 0").select("host").distinct().withColumn("in_scope", F.lit(True))
    return p.groupBy("host").agg(F.count("*").alias("n")).join(scope, "host", "left").select("host", "n", F.coalesce("in_scope", F.lit(False)).alias("in_scope"))


_STARRED = f"array_to_string(list_sort(list_transform(list_filter(string_split({_QUERY}, '&'), lambda p: p <> ''), lambda p: CASE WHEN lower(split_part(p, '=', 1)) IN {_PAGED} THEN split_part(p, '=', 1) || '=%2A' ELSE p END)), '&')"


@query(f"SELECT * FROM (SELECT page_id, CASE WHEN len(list_filter(string_split({_QUERY}, '&'), lambda p: lower(split_part(p, '=', 1)) IN {_PAGED})) > 0 THEN {_ORIGIN} || {_PATH} || '?' || {_STARRED} END AS family FROM pages) WHERE family IS NOT NULL")
def pagination_family(spark, sf_dir):
    """F06, F76."""
    return table(spark, sf_dir, "pages").select("page_id", U.pagination_family(F.col("url")).alias("family")).where("family IS NOT NULL")


@query(f"""
WITH l AS (SELECT page_id % 5 AS source_id, page_id AS ord, {_NORMAL} AS nurl, {_HOST} AS host, page_id % 4 AS depth FROM pages),
h AS (SELECT DISTINCT source_id, host FROM l WHERE ord % 3 <> 0),
r AS (SELECT l.*, CASE WHEN depth > 2 THEN 'MAX_DEPTH' WHEN h.host IS NULL THEN 'OUT_OF_SCOPE_HOST' END AS early FROM l LEFT JOIN h ON l.source_id = h.source_id AND l.host = h.host),
d AS (SELECT *, early IS NULL AND row_number() OVER (PARTITION BY source_id, nurl, early IS NULL ORDER BY ord) = 1 AS fresh FROM r),
c AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY source_id ORDER BY ord) AS place FROM d)
SELECT ord, source_id, nurl, CASE WHEN fresh AND place > 12 THEN 'MAX_URLS' ELSE early END AS reason, fresh AND place <= 12 AS admitted FROM c""")
def frontier_admission(spark, sf_dir):
    links = table(spark, sf_dir, "pages").select((F.col("page_id") % 5).alias("source_id"), F.col("page_id").alias("ord"), "url", (F.col("page_id") % 4).alias("depth"))
    hosts = links.where("ord % 3 <> 0").select("source_id", U.host(F.col("url")).alias("host"))
    return frontier.admit(links, hosts, max_urls=12).select("ord", "source_id", "nurl", "reason", "admitted")


@query(f"""
WITH l AS (SELECT page_id, {_QUERY} AS q, array_to_string(list_sort(list_distinct(list_transform(list_filter(string_split({_QUERY}, '&'), lambda p: p <> ''), lambda p: lower(split_part(p, '=', 1))))), ',') AS names FROM pages),
a AS (SELECT *, min(page_id) OVER (PARTITION BY names, q) AS first FROM l)
SELECT page_id, names, dense_rank() OVER (PARTITION BY names ORDER BY first)::INT AS variant_no FROM a""")
def query_variant_cap(spark, sf_dir):
    names = F.array_join(F.array_sort(F.array_distinct(F.transform(U.pairs(F.col("url")), lambda p: F.lower(p["k"])))), ",")
    p = table(spark, sf_dir, "pages").select("page_id", "url", names.alias("names"))
    return frontier.variant_number(p, F.col("names"), U.query(F.col("url")), ["page_id"], "variant_no").select("page_id", "names", "variant_no")


_ANCHORS = r"regexp_extract_all(html, '(?is)(<a\b[^>]*>.*?</a>)', 1)"


@query(f"""
WITH a AS (SELECT page_id, url, unnest({_ANCHORS}) AS a, generate_subscripts({_ANCHORS}, 1) - 1 AS ord FROM pages),
h AS (SELECT page_id, ord::INT AS ord, trim(regexp_extract(a, '(?i)\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1)) AS href, trim(regexp_replace(replace(regexp_replace(a, '(?is)<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '\\s+', ' ', 'g')) AS title, {_ORIGIN} AS origin FROM a)
SELECT page_id, ord, href, title, origin || href AS link FROM h WHERE href <> '' AND href NOT LIKE '#%'""")
def link_extract(spark, sf_dir):
    """F11, F62, H01, H08."""
    return H.links(table(spark, sf_dir, "pages")).select("page_id", "ord", "href", "title", "link")


@query("WITH c AS (SELECT page_id, regexp_extract_all(html, '(?s)<!--(.*?)-->', 1) AS c FROM pages) SELECT page_id, unnest(c) AS comment, (generate_subscripts(c, 1) - 1)::INT AS ord FROM c")
def comment_extract(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(H.comments(F.col("html"))).alias("ord", "comment"))


@query("SELECT sha256(text) AS digest, count(*) AS n, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id::VARCHAR) AS members, count(DISTINCT source) AS physical_sources, count(DISTINCT source) = 1 AS shared_physical FROM documents GROUP BY text HAVING count(*) >= 2")
def page_fingerprint_dups(spark, sf_dir):
    """A15, A16, A17."""
    d = table(spark, sf_dir, "documents").withColumn("digest", F.sha2("text", 256))
    return catalog.duplicate_payloads(d, "digest", "doc_id", "source")


@query(f"SELECT k, source_id, resource_key, nurl AS url, file_extension, period_label, title FROM ({RESOURCES})")
def resource_build(spark, sf_dir):
    """P01."""
    return build_resources(spark, sf_dir).select("k", "source_id", "resource_key", F.col("nurl").alias("url"), "file_extension", "period_label", "title")


@query(f"""SELECT k, yyyy || '-' || mm AS projection_period, yyyy || '-' || mm AS crawl_period, 2 AS precision
FROM ({CANDIDATES}) WHERE yyyy >= '2000' UNION ALL SELECT k, yyyy || '-' || mm, NULL, 0 FROM ({CANDIDATES}) WHERE yyyy < '2000'""")
def period_extract(spark, sf_dir):
    c = candidates(spark, sf_dir).withColumn("name", F.concat_ws("_", F.lit("x"), "mm", "yyyy"))
    none = F.lit(None).cast("string")
    crawl = T.best_period(F.col("topic"), F.col("name"))
    return c.select("k", T.period(none, F.col("title"), none, none, F.col("url")).alias("projection_period"), crawl.alias("crawl_period"), T.period_precision(F.coalesce(crawl, F.lit(""))).alias("precision"))


@query(f"SELECT source_id, topic, max(yyyy || '-' || mm) AS latest_period, count(DISTINCT yyyy || '-' || mm) AS periods FROM ({CANDIDATES}) GROUP BY ALL")
def period_sort_latest(spark, sf_dir):
    r = resources(spark, sf_dir)
    return r.groupBy("source_id", "topic").agg(F.max_by("period_label", F.struct(T.period_sort_key(F.col("period_label")), "period_label")).alias("latest_period"), F.countDistinct("period_label").alias("periods"))


@query(f"SELECT k, family_key, substr(sha256(source_id || '|' || family_key), 1, 24) AS family_id, array_to_string(list_transform(string_split(family_key, '-'), lambda w: upper(w[1]) || w[2:]), ' ') AS family_title FROM (SELECT *, CASE WHEN length(topic) >= 4 THEN topic WHEN ext = '' THEN topic ELSE topic END AS family_key FROM ({CANDIDATES}))")
def family_key(spark, sf_dir):
    c = candidates(spark, sf_dir)
    none = F.lit(None).cast("string")
    key = T.family_key(F.col("title"), none, none, F.col("url"))
    return c.select("k", key.alias("family_key"), T.family_id(F.col("source_id"), key).alias("family_id"), T.family_title(key).alias("family_title"))


_DECIDED = f"""SELECT *, CASE WHEN ext = '' THEN 'unknown' ELSE ext END AS format, topic AS family_key, yyyy || '-' || mm AS period,
  ext NOT IN ('') AS selected, CASE WHEN ext IN ('csv', 'xlsx', 'ods', 'json') THEN 'HIGH' WHEN ext = '' THEN 'LOW' ELSE 'MEDIUM' END AS priority,
  CASE WHEN ext IN ('csv', 'xlsx', 'ods', 'json') THEN 'structured_data_format' WHEN ext = 'zip' THEN 'archive_with_statistical_evidence' WHEN ext = '' THEN 'unsupported_or_unknown_format' ELSE 'periodic_document' END AS reason,
  CASE ext WHEN 'csv' THEN 120 WHEN 'xlsx' THEN 115 WHEN 'ods' THEN 108 WHEN 'json' THEN 106 WHEN 'zip' THEN 80 WHEN 'pdf' THEN 50 WHEN 'docx' THEN 40 ELSE 0 END AS rank
FROM ({RESOURCES})"""


@query(f"SELECT k, format, period, family_key, selected, priority, reason FROM ({_DECIDED})")
def projection_decisions(spark, sf_dir):
    return projection.decide(resources(spark, sf_dir)).select("k", "format", "period", "family_key", "selected", "priority", "reason")


@query(f"SELECT source_id, family_key, period, format, resource_key FROM (SELECT *, row_number() OVER (PARTITION BY source_id, family_key, period ORDER BY rank DESC, resource_key) AS rn FROM ({_DECIDED}) WHERE selected) WHERE rn = 1")
def preferred_representation(spark, sf_dir):
    return projection.preferred(decisions(spark, sf_dir)).select("source_id", "family_key", "period", "format", "resource_key")


@query(f"""WITH d AS (SELECT * FROM ({_DECIDED}) WHERE selected), f AS (SELECT source_id, family_key, string_agg(format, ',' ORDER BY rank DESC) AS formats FROM (SELECT DISTINCT source_id, family_key, format, rank FROM d) GROUP BY ALL)
SELECT d.source_id, d.family_key, count(*) AS representations, count(DISTINCT period) AS periods, any_value(formats) AS formats, max(period) AS latest_period FROM d JOIN f USING (source_id, family_key) GROUP BY 1, 2""")
def family_rollup(spark, sf_dir):
    return projection.families(decisions(spark, sf_dir))


_SLOTTED = f"""SELECT *, 'files/' || replace(array_to_string(list_transform(string_split(family_key, '-'), lambda w: upper(w[1]) || w[2:]), '_'), ' ', '_') || '/' || yyyy AS route FROM ({_DECIDED}) WHERE selected"""


@query(f"""SELECT source_id, route, CASE WHEN rn = 1 THEN 'Descargar.csv' ELSE 'Descargar_' || rn || '.csv' END AS slot, title AS descripcion, url AS url_descarga, period AS fecha_actualizacion, upper(format) AS tipo_archivo
FROM (SELECT *, row_number() OVER (PARTITION BY source_id, route ORDER BY mm DESC, rank DESC, url, resource_key) AS rn FROM ({_SLOTTED}))""")
def legacy_slots(spark, sf_dir):
    """E04, P05, W03, W04."""
    s = projection.legacy_slots(decisions(spark, sf_dir).where("selected"))
    return projection.legacy_records(s).select("source_id", "route", "slot", "descripcion", "url_descarga", "fecha_actualizacion", "tipo_archivo")


@query(f"SELECT source_id, count(*) AS valid, 0::BIGINT AS invalid FROM ({_DECIDED}) WHERE selected GROUP BY 1")
def legacy_validation(spark, sf_dir):
    """A24, A25, Z50."""
    return projection.validate_legacy(projection.legacy_records(projection.legacy_slots(decisions(spark, sf_dir).where("selected"))))


RULES = [
    projection.Rule("tables-by-topic", {"url": r"/(?P<topic>[a-z]+)_(?P<month>\d{2})_(?P<year>\d{4})\.(?:csv|xlsx|ods)"}, "{topic} tables {year}", "Tables of {topic}"),
    projection.Rule("documents", {"url": r"\.(?:pdf|docx)\?", "title": r"^(?P<topic>\S+)\s"}, "{topic} documents"),
]


@query(f"""SELECT k, rule_id, contract_key, contract_title, rule_id IS NULL AS excluded FROM (SELECT k,
  CASE WHEN regexp_matches(topic, '^[a-z]+$') AND ext IN ('csv', 'xlsx', 'ods') THEN 'tables-by-topic' WHEN regexp_matches(topic, '[a-z]+$') AND ext IN ('csv', 'xlsx', 'ods') THEN NULL WHEN ext IN ('pdf', 'docx') THEN 'documents' END AS rule_id,
  CASE rule_id WHEN 'tables-by-topic' THEN topic || '-tables-' || yyyy WHEN 'documents' THEN topic || '-documents' END AS contract_key,
  CASE rule_id WHEN 'tables-by-topic' THEN 'Tables of ' || topic WHEN 'documents' THEN array_to_string(list_transform(string_split(contract_key, '-'), lambda w: upper(w[1]) || w[2:]), ' ') END AS contract_title FROM ({CANDIDATES}))""")
def grouping_contract_match(spark, sf_dir):
    return projection.group_by_contract(candidates(spark, sf_dir), RULES).select("k", "rule_id", "contract_key", "contract_title", "excluded")


def _snapshots(spark, sf_dir):
    r = resources(spark, sf_dir)
    evidence = catalog.evidence_of_content(F.lit(None).cast("string"), F.col("etag"), F.lit(None).cast("string"))
    now = r.where("k % 10 <> 1").withColumn("evidence", F.when(F.col("k") % 7 == 0, F.concat(evidence, F.lit("b"))).otherwise(evidence))
    return now, r.where("k % 10 <> 0").withColumn("evidence", evidence)


@query(f"SELECT source_id, resource_key, CASE WHEN k % 10 = 0 THEN 'NEW' WHEN k % 10 = 1 THEN 'REMOVED' WHEN k % 7 = 0 THEN 'MODIFIED' ELSE 'UNCHANGED' END AS change_status FROM ({RESOURCES})")
def snapshot_diff(spark, sf_dir):
    return catalog.snapshot_diff(*_snapshots(spark, sf_dir))


@query(f"SELECT source_id, sha256(string_agg(s, '|' ORDER BY s)) AS resources_hash, count(*) AS total_resources FROM (SELECT source_id, concat_ws('|', resource_key, nullif(CASE WHEN etag = '' THEN '' ELSE 'etag:' || etag END || CASE WHEN k % 7 = 0 THEN 'b' ELSE '' END, '')) AS s FROM ({RESOURCES}) WHERE k % 10 <> 1) GROUP BY 1")
def snapshot_hash(spark, sf_dir):
    return catalog.resources_hash(_snapshots(spark, sf_dir)[0], ["source_id"])


@query(f"""WITH s AS (SELECT source_id, yyyy AS captured, count(*) AS total_resources, sha256(string_agg(topic || '|' || ext, '|' ORDER BY topic || '|' || ext)) AS h FROM ({RESOURCES}) GROUP BY 1, 2)
SELECT source_id, captured, total_resources, CASE WHEN lag(h) OVER w IS NULL OR lag(h) OVER w <> h THEN 'CHANGED' ELSE 'NO_CHANGE' END AS content_status FROM s WINDOW w AS (PARTITION BY source_id ORDER BY captured)""")
def content_status(spark, sf_dir):
    r = resources(spark, sf_dir).withColumn("captured", F.col("yyyy"))
    s = catalog.resources_hash(r, ["source_id", "captured"], "topic", "ext")
    return catalog.content_status(s, "source_id", "captured").select("source_id", "captured", "total_resources", "content_status")


@query(f"SELECT source_id, count(*) AS processed, count(*) FILTER (status = 'FAILED') AS failed, count(*) FILTER (status = 'CHANGED') AS changed, count(*) FILTER (status = 'NO_CHANGE') AS unchanged, min(ts) AS started_at, max(ts) AS finished_at FROM ({RUNS}) GROUP BY 1")
def run_report(spark, sf_dir):
    """A01, A02."""
    return catalog.run_report(runs(spark, sf_dir), ["source_id"])


_HEALTH = f"""SELECT source_id, run_id, failures, CASE WHEN failures = 0 THEN 'ACTIVE' WHEN failures < 3 THEN 'WARNING' ELSE 'SUSPENDED' END AS health FROM (
SELECT *, sum((status = 'FAILED')::INT) OVER (PARTITION BY source_id, island ORDER BY ts, run_id)::BIGINT AS failures FROM (
SELECT *, sum((status <> 'FAILED')::INT) OVER (PARTITION BY source_id ORDER BY ts, run_id) AS island FROM ({RUNS})))"""


@query(_HEALTH)
def health_state(spark, sf_dir):
    return state.health(runs(spark, sf_dir)).select("source_id", "run_id", "failures", "health")


@query(_HEALTH)
def streaming_health(spark, sf_dir):
    """The streaming rule over the same events, read as one available batch."""
    from ..streaming import health as stream

    base = shared_path(spark, f"stream-{uuid.uuid4().hex}")
    stream.run_available(spark, f"{sf_dir}/events.parquet", f"{base}/state", f"{base}/out")
    return spark.read.parquet(f"{base}/out").select("source_id", "run_id", "failures", "health")


@query(f"""SELECT source_id, run_id, unchanged, cadence, ts + to_days(CASE cadence WHEN 'DAILY' THEN 1 WHEN 'WEEKLY' THEN 7 ELSE 30 END) AS next_eligible_at FROM (
SELECT *, CASE WHEN unchanged >= 8 THEN 'MONTHLY' WHEN unchanged >= 7 THEN 'WEEKLY' ELSE 'DAILY' END AS cadence FROM (
SELECT *, sum((status = 'NO_CHANGE')::INT) OVER (PARTITION BY source_id, epoch ORDER BY ts, run_id)::BIGINT AS unchanged FROM (
SELECT *, sum((status = 'CHANGED')::INT) OVER (PARTITION BY source_id ORDER BY ts, run_id) AS epoch FROM ({RUNS}))))""")
def cadence_state(spark, sf_dir):
    return state.cadence(runs(spark, sf_dir)).select("source_id", "run_id", "unchanged", "cadence", "next_eligible_at")


@query(f"""WITH h AS ({_HEALTH}), l AS (SELECT source_id, arg_max(run_id, (ts, run_id)) AS run_id, max(ts) AS ts FROM ({RUNS}) GROUP BY 1),
s AS (SELECT l.source_id, h.health, l.ts + INTERVAL 1 DAY AS due FROM l JOIN h USING (source_id, run_id)), m AS (SELECT max(ts) AS now FROM events)
SELECT source_id, CASE WHEN health = 'SUSPENDED' THEN 'SUSPENDED' WHEN due > now THEN 'NOT_DUE' ELSE 'DUE' END AS reason, NOT (health = 'SUSPENDED' OR due > now) AS eligible FROM s, m""")
def eligibility_gate(spark, sf_dir):
    h = state.latest(state.health(runs(spark, sf_dir)), ["source_id"], [F.col("ts"), F.col("run_id")])
    now = table(spark, sf_dir, "events").agg(F.max("ts").alias("now"))  # one row
    s = h.select("source_id", "health", (F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("next_eligible_at")).join(F.broadcast(now))
    return state.eligibility(s, F.col("now")).select("source_id", "reason", "eligible")


@query(f"""WITH r AS (SELECT source_id AS family, ts, run_id, new_resources AS n FROM ({RUNS})),
i AS (SELECT *, sum((n <> 0)::INT) OVER (PARTITION BY family ORDER BY ts, run_id) AS island FROM r),
s AS (SELECT *, sum((n = 0)::INT) OVER (PARTITION BY family, island ORDER BY ts, run_id)::BIGINT AS empty_streak, row_number() OVER (PARTITION BY family ORDER BY ts, run_id)::INT AS page_no, sum(n) OVER (PARTITION BY family ORDER BY ts, run_id ROWS 2 PRECEDING)::BIGINT AS recent FROM i)
SELECT family, run_id, page_no, empty_streak, recent, bool_or(page_no >= 2 AND empty_streak >= 2 AND recent = 0) OVER (PARTITION BY family ORDER BY ts, run_id) AS stopped FROM s""")
def pagination_yield(spark, sf_dir):
    p = runs(spark, sf_dir).withColumnRenamed("source_id", "family")
    return state.pagination_yield(p, "family", ["ts", "run_id"], "new_resources").select("family", "run_id", "page_no", "empty_streak", "recent", "stopped")


_STATES = "CASE event_type WHEN 'view' THEN 'PENDING' WHEN 'click' THEN 'RUNNING' WHEN 'purchase' THEN 'SUCCEEDED' WHEN 'error' THEN 'FAILED' ELSE 'SKIPPED_STATUS' END"


@query(f"""WITH e AS (SELECT user_id AS source_id, event_id AS run_id, ts, {_STATES} AS state FROM events), p AS (SELECT *, lag(state) OVER (PARTITION BY source_id ORDER BY ts, run_id) AS previous FROM e)
SELECT source_id, run_id, state, previous, coalesce((previous IS NULL AND state = 'PENDING') OR (previous = 'PENDING' AND state IN ('RUNNING', 'SKIPPED_STATUS')) OR (previous = 'RUNNING' AND state IN ('SUCCEEDED', 'FAILED')) OR (previous = 'FAILED' AND state = 'RUNNING'), false) AS allowed FROM p""")
def checkpoint_validity(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("source_id"), F.col("event_id").alias("run_id"), "ts", F.expr(_STATES).alias("state"))
    return state.checkpoint_check(e, "source_id", ["ts", "run_id"], "state").select("source_id", "run_id", "state", "previous", "allowed")


@query(f"SELECT s AS state, count(e.state) AS n FROM (SELECT unnest(['PENDING', 'RUNNING', 'SUCCEEDED', 'FAILED', 'SKIPPED_STATUS']) AS s) LEFT JOIN (SELECT {_STATES} AS state FROM events WHERE event_type <> 'click') e ON e.state = s GROUP BY 1")
def checkpoint_summary(spark, sf_dir):
    return state.state_summary(table(spark, sf_dir, "events").where("event_type <> 'click'").select(F.expr(_STATES).alias("state")))


@query("SELECT event_type, 'OBJECT_METADATA_OR_SMALL' AS shape, count(*) AS n, count(*) FILTER (json_extract_string(props, '$.k')::BIGINT % 2 = 0) AS even FROM events GROUP BY 1")
def json_shape_counts(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("shape", A.data_shape(F.col("props")))
    return e.groupBy("event_type", "shape").agg(F.count("*").alias("n"), F.count_if(F.get_json_object("props", "$.k").cast("long") % 2 == 0).alias("even"))


@query("""WITH c AS (SELECT c_custkey, n_name, CASE WHEN n_nationkey % 2 = 0 THEN 'overlaid' ELSE c_mktsegment END AS segment FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT axis, value, n FROM (SELECT 'n_name' AS axis, n_name AS value, count(*) AS n FROM c GROUP BY 2 UNION ALL SELECT 'segment', segment, count(*) FROM c GROUP BY 2)""")
def plan_overlay_left_join(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"), F.col("c_mktsegment").alias("segment"))
    n = table(spark, sf_dir, "nation")
    patch = n.where("n_nationkey % 2 = 0").select("n_nationkey", F.lit("overlaid").alias("segment"))
    merged = audit.overlay(c, F.broadcast(patch), "n_nationkey", ["segment"]).join(F.broadcast(n), "n_nationkey")
    return audit.multi_histogram(merged, ["n_name", "segment"])


_SIDES = """s AS (SELECT s_suppkey, 'n' || (s_suppkey % 8) AS own, ['n' || (s_suppkey % 8), 'c' || (s_suppkey * 7 % 90)] AS names, s_nationkey AS site FROM supplier),
c AS (SELECT c_custkey, ['c' || c_custkey, CASE WHEN c_custkey % 50 = 0 THEN 'n' || (c_custkey // 50 % 6) END] AS names, c_nationkey AS site FROM customer)"""


def _sides(spark, sf_dir):
    name = lambda tag, c: F.concat(F.lit(tag), c.cast("string"))
    k, c = F.col("s_suppkey"), F.col("c_custkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", name("n", k % 8).alias("own"), F.array(name("n", k % 8), name("c", k * 7 % 90)).alias("names"), F.col("s_nationkey").alias("site"))
    return s, table(spark, sf_dir, "customer").select("c_custkey", F.array(name("c", c), F.when(c % 50 == 0, name("n", F.floor(c / 50) % 6))).alias("names"), F.col("c_nationkey").alias("site"))


@query(f"""WITH {_SIDES}, p1 AS (SELECT s_suppkey, c_custkey, list_contains(c.names, own) AS exact FROM s JOIN c ON list_has_any(s.names, list_filter(c.names, lambda x: x IS NOT NULL))),
t1 AS (SELECT s_suppkey, count(*) AS n, min(c_custkey) AS c, count(*) FILTER (exact) AS xn, min(c_custkey) FILTER (exact) AS xc FROM p1 GROUP BY 1), t2 AS (SELECT s_suppkey, count(*) AS n, min(c_custkey) AS c FROM s JOIN c ON s.site = c.site GROUP BY 1)
SELECT s.s_suppkey, CASE WHEN t1.n = 1 THEN t1.c WHEN t1.n > 1 THEN CASE WHEN xn = 1 THEN xc END WHEN t2.n = 1 THEN t2.c END AS c_custkey, CASE WHEN t1.n > 0 THEN 1 WHEN t2.n > 0 THEN 2 END AS tier,
CASE WHEN coalesce(t1.n, t2.n) IS NULL THEN 'MISSING' WHEN t1.n = 1 OR (t1.n > 1 AND xn = 1) OR (t1.n IS NULL AND t2.n = 1) THEN 'OK' ELSE 'AMBIGUOUS' END AS outcome FROM s LEFT JOIN t1 USING (s_suppkey) LEFT JOIN t2 USING (s_suppkey)""")
def fallback_match_join(spark, sf_dir):
    """J06."""
    return audit.tiered_match(*_sides(spark, sf_dir), "s_suppkey", "c_custkey", [("names", "names", "own"), ("site", "site", None)])


@query(f"WITH {_SIDES} SELECT s_suppkey, c_custkey, array_to_string(list_sort(list_intersect(s.names, c.names)), ',') AS overlap FROM s JOIN c ON list_has_any(s.names, list_filter(c.names, lambda x: x IS NOT NULL))")
def overlap_join(spark, sf_dir):
    """J07."""
    return audit.overlap_matches(*_sides(spark, sf_dir), "s_suppkey", "c_custkey", "names", "names").withColumn("overlap", F.array_join("overlap", ","))


@query("""SELECT c_custkey AS k, 'missing' AS side FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)
UNION ALL SELECT o_custkey, 'extra' FROM (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer)""")
def integrity_anti_join(spark, sf_dir):
    return catalog.differences(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), "k")


@query("""WITH a AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS evidence, 0 AS tier FROM labels), b AS (SELECT doc_id, lang AS evidence, 1 AS tier FROM documents)
SELECT doc_id, arg_min(evidence, tier) AS evidence, min(tier) AS tier FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1""")
def evidence_precedence(spark, sf_dir):
    """J13, Z57, Z65."""
    l = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("poor").alias("evidence"))
    return audit.precedence([l, table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("evidence"))], "doc_id").select("doc_id", "evidence", "tier")


@query("""WITH r AS (SELECT user_id, ts, ts + to_microseconds(round(value * 1000)::BIGINT * 1000) AS finish FROM events),
g AS (SELECT user_id, count(*) AS runs, round(sum(greatest(0, (epoch_us(finish) - epoch_us(ts)) / 1e6)), 3) AS active_s, greatest(0, (epoch_us(max(finish)) - epoch_us(min(ts))) / 1e6) AS wall FROM r GROUP BY 1)
SELECT user_id, runs, active_s, round(wall, 3) AS wall_s, round(greatest(0, wall - active_s), 3) AS gap_s FROM g""")
def timing_audit(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("finish", F.timestamp_micros(F.unix_micros("ts") + F.round(F.col("value") * 1000).cast("long") * 1000))
    t = audit.timing(e, "user_id", "ts", "finish")
    return t.select("user_id", "runs", F.round("active_s", 3).alias("active_s"), F.round("wall_s", 3).alias("wall_s"), F.round(F.greatest(F.lit(0.0), F.col("wall_s") - F.round("active_s", 3)), 3).alias("gap_s"))


@query(f"SELECT priority, count(*) AS n FROM ({_DECIDED}) GROUP BY 1")
def priority_histogram(spark, sf_dir):
    return audit.histogram(decisions(spark, sf_dir), "priority")


@query("SELECT conv_id, turn, sum((role = 'user')::INT) OVER (PARTITION BY conv_id ORDER BY turn)::BIGINT AS segment, nullif(list_last(regexp_extract_all(text, '([A-Za-z]+)', 1)), '') AS last_word FROM conversations")
def log_segmentation(spark, sf_dir):
    c = audit.log_segments(table(spark, sf_dir, "conversations"), "conv_id", "turn", F.col("role") == "user")
    return c.select("conv_id", "turn", "segment", audit.last_match(F.col("text"), "([A-Za-z]+)").alias("last_word"))




@query("SELECT o_custkey, o_orderkey, rn FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3")
def catalog_top_k(spark, sf_dir):
    return catalog.top_k(table(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey", "rn")


_EDGES = rf"""SELECT DISTINCT parent, w AS child FROM (SELECT page_id, w, min(w) OVER (PARTITION BY page_id) AS parent FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="(/[^"]*)"', 1)) AS w FROM pages)) WHERE w <> parent"""


@query(f"""WITH RECURSIVE e AS ({_EDGES}), s AS (SELECT min(parent) AS url FROM e),
b(url, depth) AS (SELECT url, 0 FROM s UNION SELECT e.child, b.depth + 1 FROM b JOIN e ON b.url = e.parent WHERE b.depth < 3)
SELECT url, min(depth) AS depth FROM b GROUP BY 1""")
def bfs_levels(spark, sf_dir):
    """From each page's least link to its others; levels are written, so none is computed again."""

    def checkpoint(df):
        path = shared_path(spark, f"level-{uuid.uuid4().hex}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    w = table(spark, sf_dir, "pages").select(F.array_sort(F.array_distinct(F.regexp_extract_all("html", F.lit('href="(/[^"]*)"'), 1))).alias("w")).where(F.size("w") > 1)
    edges = checkpoint(w.select(F.col("w")[0].alias("parent"), F.explode(F.slice("w", 2, F.size("w"))).alias("child")).distinct())
    return frontier.bfs_levels(edges, edges.agg(F.min("parent").alias("url")), 3, checkpoint)


@query(f"SELECT page_id, 'GET ' || {_ORIGIN} || CASE WHEN {_PATH} = '' THEN '/' ELSE {_PATH} END || CASE WHEN q = '' THEN '' ELSE '?' || q END AS identity FROM (SELECT *, array_to_string(list_filter(string_split({_KEPT}, '&'), lambda p: p <> '' AND split_part(p, '=', 1) <> 'page'), '&') AS q FROM pages)")
def api_identity(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", U.api_identity(F.lit("get"), F.col("url")).alias("identity"))


@query(f"SELECT k, ext AS extension, CASE WHEN ext IN ('csv', 'xlsx', 'ods') THEN 'table' WHEN ext IN ('pdf', 'docx') THEN 'document' WHEN ext = 'zip' THEN 'archive' WHEN ext = 'json' THEN 'data' ELSE 'other' END AS kind, ext <> '' AS is_resource FROM ({CANDIDATES})")
def extension_kind(spark, sf_dir):
    """F05, F10, F57."""
    e = U.extension(F.col("url"))
    return candidates(spark, sf_dir).select("k", F.regexp_replace(e, r"^\.", "").alias("extension"), U.kind_of(e).alias("kind"), U.is_resource(F.col("url")).alias("is_resource"))


@query("SELECT doc_id, CASE WHEN s = '' THEN 'resource' ELSE s END AS slug FROM (SELECT doc_id, array_to_string(regexp_extract_all(strip_accents(lower(text)), '([a-z0-9]+)', 1), '-') AS s FROM documents)")
def slugs(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.slugify(F.col("text")).alias("slug"))


@query(r"SELECT page_id, len(regexp_extract_all(html, '(?i)<a\b'))::INT AS anchors, len(regexp_extract_all(html, '(?i)<script\b'))::INT AS scripts, len(regexp_extract_all(html, '(?i)<form\b'))::INT AS forms FROM pages")
def html_signals(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", H.signals(F.col("html")).alias("s")).select("page_id", "s.anchors", "s.scripts", "s.forms")


@query("""SELECT 'part-' || p_partkey AS path, CASE WHEN p_partkey % 11 = 0 THEN 'MISSING' WHEN p_partkey % 13 = 0 THEN 'EXTRA' WHEN p_partkey % 7 = 0 THEN 'MISMATCH' ELSE 'MATCH' END AS outcome FROM part WHERE NOT (p_partkey % 11 = 0 AND p_partkey % 13 = 0)""")
def checksum_comparison(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("part-"), F.col("p_partkey").cast("string")).alias("path"), F.sha2("p_name", 256).alias("sha256"))
    actual = p.where("p_partkey % 11 <> 0").withColumn("sha256", F.when(F.col("p_partkey") % 7 == 0, F.sha2("sha256", 256)).otherwise(F.col("sha256")))
    return catalog.checksum_audit(p.where("p_partkey % 13 <> 0"), actual)


@query("SELECT event_id, user_id, rn::INT AS request_no FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 5")
def request_budget(spark, sf_dir):
    return state.within_budget(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], 5).select("event_id", "user_id", "request_no")


@query("""SELECT event_type, count(*) AS requests, count(*) FILTER (event_type = 'error') AS timeouts, count(*) FILTER (event_type = 'error') AS http_403, count(*) FILTER (event_type = 'click') AS http_429, count(*) FILTER (event_type = 'click') AS robots_blocked, count(DISTINCT user_id) AS urls FROM events GROUP BY 1""")
def fetch_error_counts(spark, sf_dir):
    line = "CASE event_type WHEN 'error' THEN 'timeout 403' WHEN 'click' THEN 'robots 429' ELSE '' END"
    return catalog.fetch_errors(table(spark, sf_dir, "events").withColumn("error", F.expr(line)).withColumn("url", F.col("user_id")), ["event_type"])


@query(f"SELECT source_id AS url, string_agg(DISTINCT topic, ',' ORDER BY topic) AS titles, string_agg(DISTINCT ext, ',' ORDER BY ext) AS methods, 'file' AS types, false AS is_api FROM ({CANDIDATES}) GROUP BY 1")
def evidence_index(spark, sf_dir):
    c = candidates(spark, sf_dir).select(F.col("source_id").alias("url"), F.col("topic").alias("title"), F.col("ext").alias("discovery_method"), F.lit("file").alias("resource_type"))
    return audit.evidence_by_url(c)


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def latest_state(spark, sf_dir):
    return state.latest(table(spark, sf_dir, "events"), ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_id", "event_type")


@query("""SELECT l_orderkey, l_linenumber, human FROM (SELECT *, bround::BIGINT AS s, CASE WHEN s >= 3600 THEN (s // 3600) || ' h ' || (s % 3600 // 60) || ' min ' || (s % 60) || ' s' WHEN s >= 60 THEN (s // 60) || ' min ' || (s % 60) || ' s' ELSE s || ' s' END AS human FROM (SELECT *, l_quantity * 100 AS bround FROM lineitem))""")
def human_durations(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", T.human_duration(F.col("l_quantity") * 100).alias("human"))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = c_mktsegment THEN 'EXACT' WHEN o_orderstatus = 'O' AND c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'COMPATIBLE_SPECIALIZATION' ELSE 'INCOMPATIBLE' END AS fit FROM orders JOIN customer ON o_custkey = c_custkey""")
def workflow_fit(spark, sf_dir):
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return o.select("o_orderkey", audit.workflow_compatibility(F.col("o_orderstatus"), F.col("c_mktsegment"), {"O": ["BUILDING", "MACHINERY"]}).alias("fit"))


@query(f"SELECT k, 'https://x.org/news/DATE' AS template, yyyy || '/' || mm AS value FROM ({CANDIDATES})")
def calendar_family(spark, sf_dir):
    c = candidates(spark, sf_dir).withColumn("u", F.concat(F.lit("https://x.org/news/"), "yyyy", F.lit("/"), "mm"))
    return c.select("k", U.calendar_family(F.col("u")).alias("c")).select("k", "c.template", "c.value")


@query("""WITH a AS (SELECT user_id, event_type, ts, 0 AS n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1),
b AS (SELECT user_id, event_type, ts, 1 AS n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE user_id % 2 = 0) WHERE rn = 1)
SELECT user_id, arg_max(event_type, (ts, n)) AS event_type FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1""")
def upsert_latest(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    first = e.withColumn("rn", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))).where("rn = 1").select("user_id", "event_type", "ts")
    last = state.latest(e.where("user_id % 2 = 0"), ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "ts")
    return sinks.upsert(first, last, ["user_id"], "ts").select("user_id", "event_type")


@query("SELECT page_id, count(*) AS anchors FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*>.*?</a>')) FROM pages) GROUP BY 1")
def anchor_contexts(spark, sf_dir):
    return H.contexts(table(spark, sf_dir, "pages"), "page_id").groupBy("page_id").agg(F.count("*").alias("anchors"))


@query("SELECT user_id % 7 AS host, string_agg(DISTINCT code, ',' ORDER BY code) FILTER (event_type = 'view') AS robots_codes, string_agg(DISTINCT code, ',' ORDER BY code) FILTER (event_type <> 'view') AS site_codes FROM (SELECT *, (200 + user_id % 3)::VARCHAR AS code FROM events) GROUP BY 1")
def status_codes(spark, sf_dir):
    """Z38, Z64."""
    e = table(spark, sf_dir, "events").select((F.col("user_id") % 7).alias("host"), F.when(F.col("event_type") == "view", "http://a/robots.txt").otherwise("http://a/x").alias("url"), (200 + F.col("user_id") % 3).cast("string").alias("code"))
    return audit.status_split(e, ["host"], "url", "code")


@query(f"SELECT date_trunc('hour', ts) AS hour, count(*) AS runs, count(*) FILTER (status = 'FAILED') AS failed FROM ({RUNS}) GROUP BY 1")
def windowed_failures(spark, sf_dir):
    from ..streaming.health import windowed_failures as windows

    return windows(runs(spark, sf_dir)).select(F.col("window.start").alias("hour"), "runs", "failed")
