"""Queries of packages, reports and registries over small tables derived from the given ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import packages, resolution
from .registry import query
from .rules import _holds, cases
from .views import RESOURCES, resources, table


@query("SELECT s_suppkey AS source_id, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE s_suppkey::VARCHAR END AS name, 'https://www.n' || s_nationkey || '.org/x' AS entrypoint, (s_suppkey % 3)::INT AS seeds, 'n' || s_nationkey || '.org' AS host FROM supplier")
def config_summaries(spark, sf_dir):
    """P12, Z63."""
    seeds = F.when(F.col("s_suppkey") % 3 > 0, F.array_repeat(F.lit("u"), (F.col("s_suppkey") % 3).cast("int")))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source_id"), F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).alias("name"), F.concat(F.lit("https://www.n"), F.col("s_nationkey").cast("string"), F.lit(".org/x")).alias("entrypoint"), seeds.alias("seeds"))
    return packages.row_summary(s)


@query("SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'OUT_OF_SCOPE_HOST' WHEN o_totalprice > 200000 THEN 'RESPONSE_TOO_LARGE' ELSE 'OK' END AS outcome FROM orders")
def policy_outcomes(spark, sf_dir):
    """S03, Z04."""
    host = lambda c: F.concat(F.lit("c"), c.cast("string"), F.lit(".org"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("source_id"), F.concat(F.lit("https://"), host(F.col("o_custkey")), F.lit("/x")).alias("url"), F.col("o_totalprice").alias("size"))
    configs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("source_id"), F.array(F.when(F.col("c_custkey") % 3 == 0, F.lit("other.org")).otherwise(host(F.col("c_custkey")))).alias("allowed_hosts"))
    return packages.apply_policy(o, configs, 200_000).select("o_orderkey", "outcome")


@query("SELECT 'https://' || page_id % 4 || '.org' AS page, count(*) AS n, count(DISTINCT url) AS sampled FROM (SELECT page_id, url FROM pages WHERE contains(lower(url), 'a') OR contains(lower(url), 'e')) GROUP BY 1")
def keyword_links(spark, sf_dir):
    """Z43."""
    p = table(spark, sf_dir, "pages").select(F.concat(F.lit("https://"), (F.col("page_id") % 4).cast("string"), F.lit(".org")).alias("page"), "url")
    return packages.keyword_links(p, "page", ["a", "e"], limit=1 << 30).select("page", "n", F.size("sample").cast("long").alias("sampled"))


@query("SELECT page_id % 6 AS page, count(*) FILTER (page_id % 2 = 0) AS gets, count(*) FILTER (page_id % 2 = 1) AS posts, count(*) FILTER (page_id % 3 = 0) AS querying, count(*) FILTER (page_id % 3 = 1) AS changing FROM pages GROUP BY 1")
def form_reviews(spark, sf_dir):
    """Z36."""
    field = F.element_at(F.array(F.lit("Search"), F.lit("password"), F.lit("x")), (F.col("page_id") % 3 + 1).cast("int"))
    f = table(spark, sf_dir, "pages").select((F.col("page_id") % 6).alias("page"), F.when(F.col("page_id") % 2 == 0, "get").otherwise("POST").alias("method"), F.array(field).alias("fields"))
    return packages.form_review(f, "page", ["search", "year"], ["password", "login"])


@query("SELECT n_name AS general, s AS special FROM nation, (SELECT unnest(['js', 'api']) AS s) WHERE n_nationkey % 2 = 0 OR s = 'js'")
def compatibility_rows(spark, sf_dir):
    """Z44."""
    n = table(spark, sf_dir, "nation").select(F.create_map(F.col("n_name"), F.when(F.col("n_nationkey") % 2 == 0, F.array(F.lit("js"), F.lit("api"))).otherwise(F.array(F.lit("js")))).alias("compatible"))
    return packages.compatibility_rows(n)


@query("SELECT doc_id, term FROM documents, (SELECT unnest(['data', 'the', 'x']) AS term) WHERE contains(text, term)")
def keyword_hits(spark, sf_dir):
    """Z72."""
    return packages.keyword_hits(table(spark, sf_dir, "documents"), "doc_id", "text", ["data", "the", "x"])


@query("SELECT count(*) = (SELECT count(*) FROM supplier) AS same_count, true AS same_records, sum(s_nationkey) AS records FROM supplier")
def package_totals(spark, sf_dir):
    """Z52."""
    m = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("legacy_records"))
    return packages.package_totals(m, m)


@query("""SELECT '{"sources":' || count(*) || ',"records":' || sum(n_nationkey) || ',"duplicate_groups":5,"ids":[' || string_agg('"' || n_name || '"', ',' ORDER BY n_name) || ']}' AS contract FROM nation""")
def consumer_contract(spark, sf_dir):
    """Z45."""
    n = table(spark, sf_dir, "nation")
    return packages.consumer_contract(n.select(F.col("n_nationkey").alias("legacy_records"), F.col("n_name").alias("logical_source_id")), table(spark, sf_dir, "region"))


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS text FROM (SELECT conv_id, text, min(turn) AS turn FROM conversations GROUP BY 1, 2) GROUP BY 1")
def text_artifacts(spark, sf_dir):
    """Z66."""
    return packages.text_artifacts(table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("ord"), "text"), "conv_id", 1 << 30)


@query("SELECT o_custkey AS report, min(o_orderkey) FILTER (o_orderpriority = '1-URGENT') AS k FROM orders GROUP BY 1")
def report_results(spark, sf_dir):
    """Of each customer's results in order, the first urgent one."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("report")).agg(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("source_id")))).alias("source_results"))
    return packages.source_result(o, F.lit("1-URGENT")).select("report", "result.k")


@query("SELECT '| n_name | n_nationkey |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || n_name || ' | ' || n_nationkey || ' |', chr(10) ORDER BY n_nationkey) AS markdown FROM nation")
def markdown_report(spark, sf_dir):
    """Z56, Z73; a control table of 25 rows."""
    return spark.createDataFrame([(packages.report_table(table(spark, sf_dir, "nation").select("n_name", "n_nationkey").orderBy("n_nationkey")),)], "markdown string")


_flows, _flows_sql = cases({"flow": ["HTTP_HTML", "Java Script", "api"], "end": ["]", " done", "\n"], "url": ["https://a.org/api/x", "https://a.org/x.png", "https://a.org/form/1"], "kind": ["image/png", "application/json", "text/html", None], "html": ["<FORM action=x>", "<p>", "<form>"], "name": ["A/", " b ", ""], "other": ["a", "B//", None]})


@query(f"""SELECT k, CASE flow WHEN 'HTTP_HTML' THEN 'httphtml' WHEN 'api' THEN 'api' ELSE 'js' END AS flow, coalesce(kind = 'application/json', false) OR (contains(url, '/api/') AND coalesce(kind, '') <> 'image/png') AS data, contains(url, '/form') AND contains(lower(html), '<form') AS form,
array_to_string(list_filter([regexp_replace(lower(trim(name)), '/+$', '')] || CASE WHEN regexp_replace(lower(trim(other)), '/+$', '') = regexp_replace(lower(trim(name)), '/+$', '') THEN [] ELSE [regexp_replace(lower(trim(other)), '/+$', '')] END, lambda x: x <> ''), ',') AS keys FROM ({_flows_sql})""")
def observed_workflows(spark, sf_dir):
    """F67, F74, Z22, Z27."""
    f = _flows(spark, sf_dir)
    log = F.concat(F.lit("[INFO] Workflow: ["), "flow", F.when(F.col("end") == " done", "]").otherwise(F.col("end")))
    return f.select(
        "k", packages.observed_workflow(log, {"javascript": "js"}).alias("flow"), resolution.is_data_event(F.col("url"), F.col("kind")).alias("data"), resolution.form_confirmed(F.col("url"), F.col("html"), ["/form"]).alias("form"), F.array_join(resolution.identity_keys(F.col("name"), F.col("other")), ",").alias("keys"),
    )


@query("SELECT page_id FROM pages WHERE page_id % 3 <> 0 UNION ALL SELECT page_id + 1000000 FROM pages")
def open_links(spark, sf_dir):
    """Paged links of stopped families are left out."""
    p = table(spark, sf_dir, "pages")
    paged = p.select("page_id", F.concat(F.lit("https://h"), (F.col("page_id") % 3).cast("string"), F.lit(".org/list?page="), F.col("page_id").cast("string")).alias("url"))
    plain = p.select(F.col("page_id") + 1000000, F.concat(F.lit("https://h0.org/x/"), F.col("page_id").cast("string")))
    stopped = p.limit(1).select(F.lit("https://h0.org/list?page=%2A").alias("family"))
    return resolution.open_links(paged.union(plain), stopped).select("page_id")


@query(f"SELECT source_id, count(*) AS n FROM ({RESOURCES}) WHERE ext = 'csv' GROUP BY 1")
def workflow_registry(spark, sf_dir):
    """A named transform out of a registry."""
    flows = resolution.Workflows()
    flows.register("tables", lambda df: df.where("ext = 'csv'").groupBy("source_id").agg(F.count("*").alias("n")))
    flows.register("all", lambda df: df)
    return flows.run("Tables", resources(spark, sf_dir))


@query(f"""SELECT doc_id, strip_accents(lower(lang || 'Éñü')) AS folded, {_holds('text', 'data')} AS found FROM documents""")
def folded_texts(spark, sf_dir):
    """folded text, and whether there is an excerpt around a word."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.fold(F.concat("lang", F.lit("Éñü"))).alias("folded"), (F.size(T.error_excerpts(F.col("text"), "data")) > 0).alias("found"))
