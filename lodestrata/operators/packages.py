"""Configuration, package and audit compositions over small control tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import api as A
from ..functions import text as T
from ..functions import urls as U
from .audit import first_n

# Limits of the probe stages.
STAGES = {"recovery": (1, 20, False), "expanded_html": (2, 60, False), "api_enriched": (2, 60, True)}


def stage_configs(sources: DataFrame) -> DataFrame:
    """P08, P09. A probe configuration of each source for each stage, in order: depth, URL cap, API discovery."""
    rows = F.array(*[F.struct(F.lit(k).alias("ord"), F.lit(n).alias("stage"), F.lit(d).alias("max_depth"), F.lit(u).alias("max_urls"), F.lit(a).alias("discover_apis")) for k, (n, (d, u, a)) in enumerate(STAGES.items())])
    return sources.select("source_id", "entrypoint", F.explode(rows).alias("s")).select("source_id", "entrypoint", "s.*")


# A probe that is run again, to be narrow.
RETRY_PROBE = {
    "workflow": "html", "update_category": "MONTHLY", "max_depth": 2, "max_urls": 180, "max_query_variants": 6, "max_consecutive_errors": 3, "max_redirects": 6, "max_calendar_variants": 6, "max_url_length": 2048, "max_query_keys": 10,
    "pagination_min_pages": 2, "pagination_empty_streak": 2, "pagination_window": 4, "discover_sitemaps": True, "max_sitemap_documents": 4, "max_sitemap_urls": 250, "max_sitemap_bytes": 750_000, "discover_apis": True, "max_api_endpoints": 12,
    "max_api_response_bytes": 750_000, "follow_api_pagination": True, "max_api_pages": 2, "max_api_records_sampled": 50, "max_api_stagnant_pages": 1, "probe_api_documentation": True, "max_api_documents": 4, "max_api_document_depth": 1,
    "max_api_document_bytes": 750_000, "rate_limit_seconds": 1.0, "ignore_robots_txt": False,
}


def retry_probes(rows: DataFrame, max_requests: int, max_runtime: int) -> DataFrame:
    """Z67. The configuration of a narrow probe of each row's candidate_entrypoint: its host with and without www. in scope."""
    host = U.host(F.col("candidate_entrypoint"))
    base = F.regexp_replace(host, r"^www\.", "")
    hosts = F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.array(host, base, F.concat(F.lit("www."), base))))
    fixed = [F.lit(v).alias(k) for k, v in RETRY_PROBE.items()]
    return rows.select("source_id", F.col("logical_code").alias("name"), F.col("candidate_entrypoint").alias("entrypoint"), F.array("candidate_entrypoint").alias("seeds"), hosts.alias("allowed_hosts"), F.lit(max_requests).alias("max_requests"), F.lit(max_runtime).alias("max_runtime_seconds"), *fixed)


def observed_resources(inspected: Column, logged: Column) -> Column:
    """Z67. The larger of the resources that a probe left and those that its log states; null counts as none."""
    return F.greatest(F.coalesce(inspected, F.lit(0)), F.coalesce(logged, F.lit(0)))


def acquisition_jobs(audit: DataFrame) -> DataFrame:
    """P11, Z30. A job as a JSON document for each source whose output another system must fetch."""
    due = audit.where(F.col("classification") == "ACQUISITION")
    return due.select("source_id", F.to_json(F.struct(F.lit("acquisition-v1").alias("schema"), "source_id", "entrypoint", F.lit("GET").alias("method"))).alias("job"))


def row_summary(config: DataFrame) -> DataFrame:
    """P12, Z63. What an audit shows of a configuration."""
    return config.select("source_id", F.coalesce("name", F.col("source_id").cast("string")).alias("name"), "entrypoint", F.coalesce(F.size("seeds"), F.lit(0)).alias("seeds"), U.canonical_host(F.col("entrypoint")).alias("host"))


def require_rows(df: DataFrame, n: int) -> DataFrame:
    """S23. The table itself; reading it fails unless it has ``n`` rows."""
    ok = df.agg(F.count("*").alias("__n"))
    return df.join(F.broadcast(ok)).where(F.coalesce(F.assert_true(F.col("__n") == n, F.lit(f"expected {n} rows")).cast("string"), F.lit("")) == "").drop("__n")


def setting(*choices: str | None, default: str) -> str:
    """S18. The first choice that is set: explicit, environment, configuration."""
    return next((c for c in choices if c), default)


def link_of(value: Column) -> Column:
    """Z15. URL of a JSON value that is a string or an object with url or href."""
    return F.coalesce(F.get_json_object(value, "$.url"), F.get_json_object(value, "$.href"), F.when(~F.ltrim(value).startswith("{"), F.regexp_replace(value, r'^\s*"|"\s*$', "")))


def apply_policy(fetches: DataFrame, configs: DataFrame, max_bytes: int = 1 << 20) -> DataFrame:
    """Z04, S03. Fetches with their source's policy: outcome OK, OUT_OF_SCOPE_HOST or RESPONSE_TOO_LARGE."""
    c = F.broadcast(configs.select("source_id", "allowed_hosts"))
    ok = F.array_contains("allowed_hosts", U.host(F.col("url")))
    return fetches.join(c, "source_id").withColumn("outcome", F.when(~ok, "OUT_OF_SCOPE_HOST").when(F.col("size") > max_bytes, "RESPONSE_TOO_LARGE").otherwise("OK")).drop("allowed_hosts")


def api_catalog(bodies: DataFrame, url: str = "url", body: str = "body", content_type: str = "content_type") -> DataFrame:
    """G04, G06, Z12, Z32. API responses as catalog rows: identity, format, records, pagination, shape; documents of an
    OpenAPI are marked, so that their operations can be taken with ``openapi_operations``."""
    out = bodies.withColumn("format", A.detect_format(F.col(body), F.col(content_type)))
    out = out.withColumns({"identity": U.api_identity(F.lit("GET"), F.col(url)), "records": A.records(F.col(body), F.col("format")), "has_pagination": A.has_pagination(F.col(body), F.col(url)), "shape": A.data_shape(F.col(body))})
    return out.withColumn("is_openapi", F.coalesce(F.col("format") == "openapi", F.lit(False))).where(F.col("format").isNotNull()).drop(body)


def candidate_urls(*lists: Column) -> Column:
    """Z28, Z33. Ordered union of URL lists, without nulls and repeats."""
    empty = F.array().cast("array<string>")
    return F.array_distinct(F.filter(F.concat(*[F.coalesce(c, empty) for c in lists]), lambda u: u.isNotNull() & (u != "")))


def keyword_links(links: DataFrame, by: str, words: list[str], limit: int = 50) -> DataFrame:
    """Z43. Of each source the number of links that hold a word, and the first ``limit`` distinct ones of them."""
    hit = links.where(F.lower("url").rlike("|".join(words)))
    some = first_n(hit.select(by, "url").distinct(), [by], ["url"], limit).groupBy(by).agg(F.sort_array(F.collect_list("url")).alias("sample"))
    return hit.groupBy(by).agg(F.count("*").alias("n")).join(some, by)


def form_review(forms: DataFrame, by: str, querying: list[str], changing: list[str]) -> DataFrame:
    """Z36. Forms of each page by method, and how many look like queries or like changes."""
    names = F.lower(F.array_join("fields", " "))
    return forms.groupBy(by).agg(F.count_if(F.upper("method") == "GET").alias("gets"), F.count_if(F.upper("method") == "POST").alias("posts"), F.count_if(names.rlike("|".join(querying))).alias("querying"), F.count_if(names.rlike("|".join(changing))).alias("changing"))


def remediation_state(selected: DataFrame, saved: DataFrame) -> DataFrame:
    """Z37. State and attempts of each selected source, PENDING and 0 where none is saved."""
    return selected.select("source_id").join(saved.select("source_id", "state", "attempts"), "source_id", "left").select("source_id", F.coalesce("state", F.lit("PENDING")).alias("state"), F.coalesce("attempts", F.lit(0)).alias("attempts"))


def compatibility_rows(rows: DataFrame) -> DataFrame:
    """Z44. (general, special) of a table with a map column ``compatible`` (name -> array of names)."""
    return rows.select(F.explode("compatible").alias("general", "many")).select("general", F.explode("many").alias("special"))


def keyword_hits(texts: DataFrame, path: str, text: str, terms: list[str]) -> DataFrame:
    """Z72, Z44. Terms that each text holds."""
    return texts.select(path, F.explode(F.filter(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(F.col(text), t))).alias("term"))


def choose_file(files: DataFrame, key: str, canonical: Column) -> DataFrame:
    """Z48, Z49, Z68. The one file of each key, the canonical path before others; MISSING never shows, AMBIGUOUS does."""
    w = Window.partitionBy(key, canonical.cast("int"))
    n = files.withColumn("__c", canonical.cast("int")).withColumn("__n", F.count("*").over(w))
    best = n.withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy(F.col("__c").desc(), "path"))).where("__rn = 1")
    return best.select(key, "path", F.when(F.col("__n") == 1, "OK").otherwise("AMBIGUOUS").alias("outcome"))


def package_totals(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Z52. One row: whether manifest and files agree in number and records."""
    m = manifest.agg(F.count("*").alias("mn"), F.sum("legacy_records").alias("mr"))
    f = files.agg(F.count("*").alias("fn"), F.sum("legacy_records").alias("fr"))
    return m.join(F.broadcast(f)).select((F.col("mn") == F.col("fn")).alias("same_count"), F.col("mr").eqNullSafe(F.col("fr")).alias("same_records"), F.col("fr").alias("records"))


def projection_outcome(records: Column, error: Column, special: Column) -> Column:
    """Z55. A source's outcome: special ones give an acquisition job or fail (ACQUISITION_JOB_READY, SPECIALIZATION_FAILED), others
    PROJECTION_FAILED, PROJECTION_EMPTY or DATAX_READY by their error and number of records. ``error``: a message or null."""
    failed = error.isNotNull()
    plain = F.when(failed, "PROJECTION_FAILED").when(F.coalesce(records, F.lit(0)) > 0, "DATAX_READY").otherwise("PROJECTION_EMPTY")
    return F.when(F.coalesce(special, F.lit(False)), F.when(failed, "SPECIALIZATION_FAILED").otherwise("ACQUISITION_JOB_READY")).otherwise(plain)


def consumer_contract(manifest: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Z45. The contract document of a package as one row of JSON; as large as the manifest."""
    m = manifest.agg(F.count("*").alias("sources"), F.sum("legacy_records").alias("records"), F.sort_array(F.collect_list("logical_source_id")).alias("ids"))
    d = duplicates.agg(F.count("*").alias("duplicate_groups"))
    return m.join(F.broadcast(d)).select(F.to_json(F.struct("sources", "records", "duplicate_groups", "ids")).alias("contract"))


def promoted(current: DataFrame, desired: DataFrame) -> DataFrame:
    """Z59, P10. Kept configurations (matched by id, else by a URL that only one has) and generated ones: origin tells."""
    by_url = current.select(U.entrypoint(F.lower("entrypoint")).alias("__u"), F.col("source_id").alias("__s"))
    single = by_url.groupBy("__u").agg(F.count("*").alias("__n"), F.min("__s").alias("__s")).where("__n = 1")
    ids = current.select(F.col("source_id").alias("__i"))
    d = desired.withColumn("__u", U.entrypoint(F.lower("entrypoint"))).join(ids, F.lower("source_id") == F.lower("__i"), "left").join(single, "__u", "left")
    return d.select("source_id", "entrypoint", F.coalesce("__i", "__s", "source_id").alias("config_id"), F.when(F.col("__i").isNotNull(), "KEPT_BY_ID").when(F.col("__s").isNotNull(), "KEPT_BY_URL").otherwise("GENERATED").alias("origin"))


def text_artifacts(files: DataFrame, by: str, most: int = 200_000) -> DataFrame:
    """Z66. Texts of each source's stages in order, at most ``most`` characters of a file: a report's excerpt, not data."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("ord", F.substring("text", 1, most).alias("t")))), lambda x: x["t"])
    return files.groupBy(by).agg(F.array_join(F.array_distinct(parts), "\n").alias("text"))


def source_result(reports: DataFrame, source_id: Column) -> DataFrame:
    """Z70. The first result of a source within each report's array ``source_results``."""
    return reports.withColumn("result", F.try_element_at(F.filter("source_results", lambda r: r["source_id"] == source_id), F.lit(1)))


def report_table(df: DataFrame, limit: int = 1000) -> str:
    """Z56, Z73. A small table as Markdown, at most ``limit`` rows."""
    cols = df.columns
    lines = ["| " + " | ".join(cols) + " |", "|" + "---|" * len(cols)]
    return "\n".join(lines + ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in df.limit(limit).collect()])


def audit_row(resources: DataFrame, legacy: DataFrame, states: DataFrame) -> DataFrame:
    """Z18, Z58, Z69, Z71. Of each source: state, resources, valid records, and whether its output can be consumed."""
    from .rules import output_class

    n = resources.groupBy("source_id").agg(F.count("*").alias("resources"), F.count_if(F.col("resource_type") == "api").alias("apis"))
    out = states.join(n, "source_id", "left").join(legacy, "source_id", "left").na.fill(0, ["resources", "apis", "valid", "invalid"])
    no = F.lit(False)
    d = output_class(no, F.col("state").isNotNull(), F.col("state"), no, F.col("resources"), F.col("valid"))
    return out.select("source_id", "state", "resources", "apis", "valid", "invalid", d.alias("classification"))


def observed_workflow(log: Column, aliases: dict[str, str] | None = None) -> Column:
    """Z27. The workflow that a log names, in its normal form."""
    return T.workflow_name(F.regexp_extract(log, r"(?i)workflow\s*[=:]\s*\[?([\w -]+)", 1), aliases)
