"""Registered queries of audit joins and rollups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evidence, literals, packages, resolution
from ..operators import rules as R
from .registry import query
from .rules import _holds, _signals_sql, cases
from .views import table

_LOGS = """WITH m AS (SELECT c_custkey AS source_id, c_name AS logical_code, CASE c_nationkey % 3 WHEN 0 THEN 'BLOCKED' ELSE 'READY_FOR_B10_LIVE' END AS execution_state, CASE c_nationkey % 2 WHEN 0 THEN 'html' ELSE 'api' END AS expected_workflow FROM customer),
o AS (SELECT o_custkey AS source_id, count(*)::BIGINT AS n, max(o_orderkey) AS last FROM orders GROUP BY 1),
s AS (SELECT source_id, ['html', 'api', NULL][last % 3 + 1] AS actual_workflow, CASE WHEN last % 7 = 0 THEN 'x Traceback (most recent call last): y' WHEN last % 11 = 0 THEN '[error] ParserRejectedMarkup' ELSE 'fine' END AS line, CASE WHEN last % 5 = 0 THEN 0 WHEN last % 13 = 0 THEN NULL ELSE n END AS resource_count FROM o WHERE last % 6 > 0),
k AS (SELECT source_id, CASE WHEN last % 17 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS checkpoint_state FROM o WHERE last % 19 > 0)"""


@query(f"""{_LOGS}, j AS (SELECT m.source_id, logical_code, expected_workflow, actual_workflow, checkpoint_state, resource_count, s.source_id IS NULL AS lost, CASE WHEN s.source_id IS NULL THEN ['MISSING_LOG_SEGMENT'] ELSE {_signals_sql} END AS signals
FROM m LEFT JOIN s ON m.source_id = s.source_id LEFT JOIN k ON m.source_id = k.source_id WHERE execution_state = 'READY_FOR_B10_LIVE'),
c AS (SELECT *, CASE WHEN lost THEN 'MISSING_LOG_SEGMENT' WHEN checkpoint_state IS DISTINCT FROM 'SUCCEEDED' THEN 'CHECKPOINT_NOT_SUCCEEDED' WHEN len(signals) > 0 THEN 'PROCESS_OK_WITH_INTERNAL_ERROR' WHEN actual_workflow <> expected_workflow THEN 'WORKFLOW_MISMATCH' WHEN resource_count = 0 THEN 'ZERO_RESOURCES_REVIEW'
  WHEN actual_workflow IS NULL THEN 'WORKFLOW_NOT_OBSERVED_WARNING' WHEN resource_count IS NULL THEN 'RESOURCE_COUNT_NOT_OBSERVED_WARNING' ELSE 'CLEAN_SUCCESS' END AS classification FROM j)
SELECT source_id, logical_code, expected_workflow, actual_workflow, checkpoint_state, resource_count, array_to_string(signals, ',') AS error_signals, classification, classification NOT LIKE '%WARNING' AND classification <> 'CLEAN_SUCCESS' AS blocks,
CASE WHEN classification LIKE '%WARNING' THEN 'WARNING' WHEN classification = 'CLEAN_SUCCESS' THEN 'OK' WHEN classification = 'ZERO_RESOURCES_REVIEW' THEN 'REVIEW' ELSE 'ERROR' END AS severity FROM c""")
def segment_audits(spark, sf_dir):
    """J08."""
    m = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("source_id"), F.col("c_name").alias("logical_code"), F.when(F.col("c_nationkey") % 3 == 0, "BLOCKED").otherwise("READY_FOR_B10_LIVE").alias("execution_state"), F.when(F.col("c_nationkey") % 2 == 0, "html").otherwise("api").alias("expected_workflow")
    )
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("source_id")).agg(F.count("*").alias("n"), F.max("o_orderkey").alias("last"))
    text = F.when(F.col("last") % 7 == 0, "x Traceback (most recent call last): y").when(F.col("last") % 11 == 0, "[error] ParserRejectedMarkup").otherwise("fine")
    flow = F.when(F.col("last") % 3 == 0, "html").when(F.col("last") % 3 == 1, "api")
    found = F.when(F.col("last") % 5 == 0, 0).when(F.col("last") % 13 == 0, None).otherwise(F.col("n"))
    s = o.where("last % 6 > 0").select("source_id", flow.alias("actual_workflow"), text.alias("text"), found.alias("resource_count"))
    k = o.where("last % 19 > 0").select("source_id", F.when(F.col("last") % 17 == 0, "FAILED").otherwise("SUCCEEDED").alias("state"))
    return evidence.segment_audit(m, s, k).withColumn("error_signals", F.array_join("error_signals", ","))


_STATUS = "['CUSTOM_DATA_ENDPOINT_CONFIRMED', 'CUSTOM_NO_DATA_EVIDENCE', 'CUSTOM_REQUIRES_FORM_POLICY', 'CUSTOM_IDENTITY_UNRESOLVED']"
_POLICY = "['RESOLVED_NO_PUBLIC_DATA_SCOPE', 'RESOLVED_CURATED_HTTP_SEEDS', 'READ_ONLY_POST_QUERY_CANDIDATES']"


@query(f"""WITH j AS (SELECT p_partkey AS source_id, CASE WHEN p_partkey % 9 > 0 THEN {_STATUS}[p_partkey % 4 + 1] END AS status, CASE WHEN p_partkey % 5 > 0 THEN {_POLICY}[p_partkey % 3 + 1] END AS policy, p_partkey % 2 AS few FROM part)
SELECT source_id, CASE WHEN status = 'CUSTOM_DATA_ENDPOINT_CONFIRMED' AND few > 0 THEN 'OPERATIONAL_CUSTOM_DATA_API' WHEN status = 'CUSTOM_NO_DATA_EVIDENCE' THEN 'NO_PUBLIC_DATA_EVIDENCE' WHEN status = 'CUSTOM_IDENTITY_UNRESOLVED' THEN 'IDENTITY_UNRESOLVED' WHEN status = 'CUSTOM_REQUIRES_FORM_POLICY' AND policy = 'RESOLVED_NO_PUBLIC_DATA_SCOPE' THEN 'NO_PUBLIC_DATA_SCOPE'
  WHEN status = 'CUSTOM_REQUIRES_FORM_POLICY' AND policy = 'RESOLVED_CURATED_HTTP_SEEDS' AND few > 0 THEN 'OPERATIONAL_HTTP_HTML_CURATED' WHEN status = 'CUSTOM_REQUIRES_FORM_POLICY' AND policy = 'READ_ONLY_POST_QUERY_CANDIDATES' AND few > 0 THEN 'OPERATIONAL_CUSTOM_FORM_RESOURCE' END AS resolution_status,
  CASE resolution_status WHEN 'OPERATIONAL_CUSTOM_DATA_API' THEN 'custom' WHEN 'OPERATIONAL_CUSTOM_FORM_RESOURCE' THEN 'custom' WHEN 'OPERATIONAL_HTTP_HTML_CURATED' THEN 'html' END AS workflow_strategy, CASE WHEN workflow_strategy IS NOT NULL THEN 'OPERATIONAL_CONFIG' WHEN resolution_status IS NOT NULL THEN 'B10_STATUS' END AS next_phase,
  CASE WHEN status = 'CUSTOM_NO_DATA_EVIDENCE' AND source_id % 7 > 0 AND source_id % 2 = 1 THEN 'https://new.org/' || source_id END AS entrypoint_override,
  CASE WHEN status IS NULL THEN 'MISSING_PROBE' WHEN resolution_status IS NOT NULL THEN NULL WHEN status = 'CUSTOM_DATA_ENDPOINT_CONFIRMED' THEN 'NO_CONFIRMED_ENDPOINT' WHEN policy IS NULL THEN 'MISSING_POLICY' WHEN policy = 'RESOLVED_CURATED_HTTP_SEEDS' THEN 'NO_SUCCESSFUL_SEED' ELSE 'FORM_NOT_CONFIRMED' END AS error FROM j""")
def candidate_resolutions(spark, sf_dir):
    """J10."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("source_id"))
    pick = lambda text: F.expr(text.replace("[", "array(").replace("]", ")"))
    k = F.col("source_id")
    probes = p.where("source_id % 9 > 0").select("source_id", pick(_STATUS)[(k % 4).cast("int")].alias("status"), (k % 2).alias("endpoints"), (k % 2).alias("seeds"))
    policies = p.where("source_id % 5 > 0").select("source_id", pick(_POLICY)[(k % 3).cast("int")].alias("policy_status"), (k % 2 > 0).alias("form_confirmed"))
    identities = p.where("source_id % 7 > 0").select("source_id", F.when(k % 2 == 1, "RESOLVED_SAME_INSTITUTION").otherwise("OTHER").alias("identity_status"), F.concat(F.lit("https://new.org/"), k.cast("string")).alias("candidate_entrypoint"))
    return resolution.resolve_candidates(p, probes, policies, identities)


@query("""WITH i AS (SELECT lower(p_name) AS k, max(p_name) AS inventory_id, arg_max(p_partkey, p_name) AS p_partkey FROM (SELECT p_partkey, CASE p_partkey % 2 WHEN 0 THEN upper(p_brand || p_type) ELSE lower(p_brand || p_type) END || p_partkey AS p_name FROM part WHERE p_partkey % 3 > 0) GROUP BY 1)
SELECT q.p_partkey AS k, i.inventory_id, i.p_partkey AS owner FROM part q LEFT JOIN i ON lower(q.p_brand || q.p_type || q.p_partkey) = i.k""")
def folded_lookups(spark, sf_dir):
    """J18."""
    p = table(spark, sf_dir, "part").withColumn("name", F.concat("p_brand", "p_type"))
    inventory = p.where("p_partkey % 3 > 0").select(F.concat(F.when(F.col("p_partkey") % 2 == 0, F.upper("name")).otherwise(F.lower("name")), F.col("p_partkey").cast("string")).alias("source_id"), F.col("p_partkey").alias("owner"))
    return resolution.folded_lookup(p.select(F.col("p_partkey").alias("k"), F.concat("name", F.col("p_partkey").cast("string")).alias("id")), inventory, "id").select("k", "inventory_id", "owner")


_EXTS = "['.csv', '.pdf', '.zip', '', '.xlsx', '']"


@query(f"""WITH r AS (SELECT o_custkey % 60 AS source_id, o_orderkey % 400 AS u, o_custkey % 60 % 6 AS top FROM orders),
n AS (SELECT DISTINCT source_id, u, {_EXTS}[CASE WHEN top < 3 THEN top + u % (4 - top) ELSE 3 END + 1] AS extension, u % 4 = 0 AND source_id % 5 > 0 AS api, CASE source_id % 4 WHEN 0 THEN 'wp' WHEN 1 THEN CASE WHEN u % 8 = 0 THEN 'doc' ELSE 'wp' END WHEN 2 THEN CASE WHEN u % 8 = 0 THEN 'data' ELSE 'wp' END ELSE CASE WHEN u % 8 = 0 THEN 'other' ELSE 'wp' END END AS kind FROM r),
q AS (SELECT source_id, count(*) AS resource_count, count(*) FILTER (api) AS api_resource_count, count(*) FILTER (api AND kind IN ('wp', 'doc')) AS catalog, count(*) FILTER (api AND kind = 'data') AS possible, count(*) FILTER (extension IN ('.csv', '.xlsx')) AS data_files, count(*) FILTER (extension = '.pdf') AS document_files, count(*) FILTER (extension = '.zip') AS archive_files FROM n GROUP BY 1)
SELECT source_id, resource_count, api_resource_count, data_files, document_files, archive_files, CASE WHEN api_resource_count = 0 THEN 'NO_API_EVIDENCE' WHEN catalog = api_resource_count THEN 'CMS_OR_METADATA_ONLY' WHEN possible > 0 THEN 'DATA_API_EVIDENCE' ELSE 'GENERIC_API_REVIEW' END AS api_quality,
CASE WHEN data_files > 0 THEN 'STRUCTURED_FILE_EVIDENCE' WHEN document_files > 0 THEN 'DOCUMENT_FILE_EVIDENCE' WHEN archive_files > 0 THEN 'ARCHIVE_EVIDENCE' ELSE 'LINK_OR_API_EVIDENCE' END AS file_quality FROM q""")
def evidence_qualities(spark, sf_dir):
    """A30."""
    r = table(spark, sf_dir, "orders").selectExpr("o_custkey % 60 AS source_id", "o_orderkey % 400 AS u").withColumn("top", F.col("source_id") % 6)
    ext = F.expr(_EXTS.replace("[", "array(").replace("]", ")"))[F.when(F.col("top") < 3, F.col("top") + F.col("u") % (4 - F.col("top"))).otherwise(3).cast("int")]
    special = F.expr("CASE source_id % 4 WHEN 1 THEN '/swagger/' WHEN 2 THEN '/api/data/' WHEN 3 THEN '/rest/thing/' ELSE '/wp-json/' END")
    place = F.when(F.col("u") % 8 == 0, special).otherwise("/wp-json/")
    r = r.select("source_id", F.concat(F.lit("https://a.org"), place, F.col("u").cast("string")).alias("url"), ext.alias("extension"), ((F.col("u") % 4 == 0) & (F.col("source_id") % 5 > 0)).alias("api"))
    return evidence.evidence_quality(r)


@query("""SELECT c_custkey AS source_id, c_name AS name, CASE c_custkey % 3 WHEN 0 THEN 'https://www.a' || c_custkey || '.org/x' WHEN 1 THEN 'http://b' || c_custkey || '.org:8080' ELSE 'none' END AS entrypoint, CASE c_custkey % 3 WHEN 0 THEN 'www.a' || c_custkey || '.org,a' || c_custkey || '.org' WHEN 1 THEN 'b' || c_custkey || '.org,www.b' || c_custkey || '.org' ELSE '' END AS hosts, 180 AS max_urls, 2 AS max_api_pages, 40 AS max_requests, greatest(c_nationkey, c_custkey % 30)::BIGINT AS resources FROM customer""")
def retry_probes(spark, sf_dir):
    """Z67."""
    k = F.col("c_custkey").cast("string")
    url = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("https://www.a"), k, F.lit(".org/x"))).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("http://b"), k, F.lit(".org:8080"))).otherwise("none")
    c = table(spark, sf_dir, "customer")
    out = packages.retry_probes(c.select(F.col("c_custkey").alias("source_id"), F.col("c_name").alias("logical_code"), url.alias("candidate_entrypoint")), 40, 300)
    n = c.select(F.col("c_custkey").alias("source_id"), packages.observed_resources(F.when(F.col("c_nationkey") > 0, F.col("c_nationkey")), F.col("c_custkey") % 30).cast("long").alias("resources"))
    return out.join(n, "source_id").select("source_id", "name", "entrypoint", F.array_join("allowed_hosts", ",").alias("hosts"), "max_urls", "max_api_pages", "max_requests", "resources")


_seeds, _seeds_sql = cases({"link": ["https://a.org/x.CSV", "https://a.org/x.parquet?y=1", "https://a.org/Boletines/", "https://a.org/about", "https://a.org/csvx", "https://a.org/?q=Export", "https://a.org/x.zip/y", None], "reached": [0, 1, 4], "discovered": [0, 2]})


@query(f"""SELECT k, coalesce(regexp_matches(lower(regexp_extract(link, '^https://[^/]+([^?]*)', 1)), '\\.(csv|xlsx|xls|ods|json|xml|parquet|zip|pdf)$'), false) OR {_holds("link", *R.SEED_WORDS)} AS resource,
CASE WHEN reached > 0 AND discovered > 0 THEN 'RESOLVED_CURATED_HTTP_SEEDS' WHEN reached > 0 THEN 'CURATED_SEEDS_REACHABLE_NO_RESOURCES' ELSE 'CURATED_SEEDS_UNREACHABLE' END AS status FROM ({_seeds_sql})""")
def seed_resources(spark, sf_dir):
    """C21."""
    s = _seeds(spark, sf_dir)
    return s.select("k", R.seed_resource(F.col("link")).alias("resource"), R.curated_seeds(F.col("reached"), F.col("discovered"))["status"].alias("status"))


@query("""WITH t AS (SELECT p_partkey AS k, p_partkey % 7 AS s, 'Sales of ' || upper(p_name) || ' ' || p_brand AS title FROM part),
r AS (SELECT p_partkey AS rule_id, CASE p_partkey % 2 WHEN 0 THEN p_partkey % 7 END AS scope, lower(p_name || ' ' || p_brand) AS ending, p_partkey * 7919 % 10007 AS priority FROM part WHERE p_partkey % 3 = 0)
SELECT k, arg_min(rule_id, (priority, rule_id)) AS rule_id FROM t JOIN r ON ends_with(lower(title), ending) AND coalesce(scope, s) = s GROUP BY k""")
def first_rule_matches(spark, sf_dir):
    """A rule of every third part over the titles of all."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    texts = p.select(k.alias("k"), (k % 7).alias("s"), F.concat(F.lit("Sales of "), F.upper("p_name"), F.lit(" "), F.col("p_brand")).alias("title"))
    rules = p.where("p_partkey % 3 = 0").select(k.alias("rule_id"), (k * 7919 % 10007).alias("priority"), F.concat(F.col("p_name"), F.lit(r"\s"), F.col("p_brand"), F.lit("$")).alias("pattern"), F.when(k % 2 == 0, k % 7).alias("scope"))
    return literals.first_rules(texts, "k", "title", rules, "s")


@query("SELECT doc_id, item_id AS literal_id FROM documents, (SELECT item_id, substr(text, 1, 12) AS t FROM benchmark WHERE text <> '') WHERE contains(text, t)")
def literal_hits(spark, sf_dir):
    """The beginnings of all benchmark items in all documents."""
    terms = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("literal_id"), F.substring("text", 1, 12).alias("literal"))
    return literals.literal_hits(table(spark, sf_dir, "documents"), ["doc_id"], "text", terms)
