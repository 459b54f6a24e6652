"""Source resolution and supporting operators: matching, precedence, caps, classes of URLs and events, run bookkeeping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import urls as U

# Fixed values.
METHOD_LABELS = {"html": "html_link", "commented_html": "html_comment", "javascript": "rendered_dom", "sitemap": "sitemap", "api": "api_reference", "seed": "seed"}
DATA_WORDS = r"(?i)\.(csv|tsv|xlsx?|ods|json|xml|geojson)(\?|$)|/api/|/data/|format=(csv|json|xml)|export|download"
HEAVY_TYPES = r"(?i)^(image|font|video|audio)/|text/css"


class Workflows:
    """E01, E02, E06. Named transforms of a DataFrame: a registry of DataFrame -> DataFrame functions."""

    def __init__(self):
        self._known: dict[str, Callable[[DataFrame], DataFrame]] = {}

    def register(self, name: str, f: Callable[[DataFrame], DataFrame]) -> None:
        self._known[name.lower()] = f

    def is_registered(self, name: str) -> bool:
        return name.lower() in self._known

    def run(self, name: str, df: DataFrame) -> DataFrame:
        if not self.is_registered(name):
            raise LookupError(name)
        return df.transform(self._known[name.lower()])


def only_source(configs: DataFrame, source_id: str) -> DataFrame:
    """F51, P07, Z23. The one configuration of an id in any case; none or several raise LookupError."""
    out = configs.where(F.lower("source_id") == source_id.lower())
    if (n := out.count()) != 1:
        raise LookupError(f"{source_id}: {n} configurations")
    return out


def effective_title(title: Column, url: Column) -> Column:
    """F20. Title, else the path's last part, else the URL."""
    name = F.nullif(F.regexp_extract(U.path(url), r"([^/]*)/*$", 1), F.lit(""))
    return F.coalesce(T.blank_to_null(title), name, url)


def api_title(title: Column, method: Column, url: Column) -> Column:
    """P02. Title, else ``API METHOD /path``."""
    return F.coalesce(T.blank_to_null(title), F.concat_ws(" ", F.lit("API"), F.upper(method), U.path(url)))


def description(context: Column, anchor: Column, title: Column, url: Column) -> Column:
    """P03. The first that is not blank."""
    return F.coalesce(T.blank_to_null(context), T.blank_to_null(anchor), T.blank_to_null(title), url)


def method_label(kind: Column) -> Column:
    """Z11."""
    known = F.create_map(*[F.lit(x) for pair in METHOD_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(kind)), F.lit("html_link"))


def redirect_allowed(url: Column, hosts: Column) -> Column:
    """F65, Z03. A web URL whose host is among those allowed."""
    return U.scheme(url).isin("http", "https") & F.array_contains(hosts, U.host(url))


def forbidden_methods(methods: Column) -> Column:
    """F66. Methods beyond GET and HEAD."""
    return F.array_except(F.transform(methods, lambda m: F.upper(m)), F.array(F.lit("GET"), F.lit("HEAD")))


def form_confirmed(url: Column, html: Column, patterns: list[str]) -> Column:
    """F67. A form on a page whose URL holds one of the patterns."""
    hit = F.lit(False)
    for p in patterns:
        hit = hit | F.contains(url, F.lit(p))
    return hit & F.contains(F.lower(html), F.lit("<form"))


def looks_like_data(url: Column) -> Column:
    """F73, F75."""
    return url.rlike(DATA_WORDS)


def is_data_event(url: Column, content_type: Column) -> Column:
    """F74. A network event that carries data: by type, or by URL if its type is not a heavy one."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    return kind.rlike("json|csv|xml|spreadsheet") | (looks_like_data(url) & ~kind.rlike(HEAVY_TYPES))


def package_ready(rows: DataFrame, expected: int, terminal: list[str]) -> DataFrame:
    """F78. One row: whether all expected sources are there and each has a terminal class."""
    return rows.agg(((F.count("*") == expected) & F.coalesce(F.bool_and(F.col("classification").isin(*terminal)), F.lit(False))).alias("ready"))


def remediation(sources: DataFrame, reports: DataFrame) -> DataFrame:
    """F71. Sources without a report, without success, or with an empty result."""
    r = reports.select("source_id", F.col("execution_status").alias("__e"), F.col("content_status").alias("__c"))
    return sources.join(r, "source_id", "left").where(F.col("__e").isNull() | (F.col("__e") != "SUCCESS") | (F.col("__c") == "EMPTY_RESULT")).drop("__e", "__c")


def with_fallback(rows: DataFrame, key: str, lookup: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """J14, J17. Columns of the lookup row that shares (source_id, key), else of the source's latest by ``order``."""
    exact = lookup.select("source_id", key, *[F.col(c).alias(f"__e_{c}") for c in columns])
    newest = lookup.groupBy("source_id").agg(*[F.max_by(c, order).alias(f"__n_{c}") for c in columns])
    out = rows.join(exact, ["source_id", key], "left").join(newest, "source_id", "left")
    return out.select(*rows.columns, *[F.coalesce(f"__e_{c}", f"__n_{c}").alias(c) for c in columns])


def fan_out(logical: DataFrame, physical: DataFrame, url: str = "entrypoint") -> DataFrame:
    """J11, J12, Z41. Logical rows with the result of the physical source that shares their entrypoint."""
    p = physical.withColumn("__u", U.entrypoint(F.col(url))).drop(url, "source_id")
    return logical.withColumn("__u", U.entrypoint(F.col(url))).join(p, "__u").drop("__u")


def groups_of_config(rows: DataFrame) -> DataFrame:
    """A21, Z60, Z61. Rows by physical id, else URL, else logical id: representative, seeds in order, and whether entrypoint
    and workflow are single-valued."""
    key = F.coalesce(T.blank_to_null(F.col("physical_id")), T.blank_to_null(F.col("entrypoint")), F.col("logical_id"))
    first = F.min_by("logical_id", F.struct(F.col("logical_id") != F.col("physical_id"), "ord"))
    seeds = F.array_join(F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("ord", "entrypoint"))), lambda x: x["entrypoint"])), ",")
    return rows.groupBy(key.alias("group_key")).agg(first.alias("representative"), seeds.alias("seeds"), (F.countDistinct("entrypoint") == 1).alias("one_entrypoint"), (F.countDistinct("workflow") == 1).alias("one_workflow"))


def evidence_counts(resources: DataFrame) -> DataFrame:
    """A14, A29. Distinct URLs of each discovery method and type."""
    kinds = F.explode(F.array(F.concat(F.lit("method:"), "discovery_method"), F.concat(F.lit("type:"), "resource_type")))
    return resources.select("url", kinds.alias("kind")).groupBy("kind").agg(F.countDistinct("url").alias("urls"))


# Classes that end well.
GOOD_CLASSES = ["DATAX_READY", "ACQUISITION_JOB_READY", "EXTERNAL_BLOCKER"]


def pipeline_state(rows: DataFrame, package: DataFrame) -> DataFrame:
    """A32. One row: PARTIAL while a source's classification is PENDING, FAILED if any is not among GOOD_CLASSES (null included),
    else PACKAGE_NOT_BUILT without a row in ``package`` (package_ready), PACKAGE_REVIEW if it is not ready, READY."""
    c = F.col("classification")
    a = rows.agg(F.count_if(c == "PENDING").alias("pending"), F.count_if(~F.coalesce(c.isin("PENDING", *GOOD_CLASSES), F.lit(False))).alias("unresolved"))
    p = package.agg(F.count("*").alias("built"), F.bool_and(F.coalesce("package_ready", F.lit(False))).alias("ready"))
    state = F.when(F.col("pending") > 0, "PARTIAL").when(F.col("unresolved") > 0, "FAILED").when(F.col("built") == 0, "PACKAGE_NOT_BUILT").when(~F.col("ready"), "PACKAGE_REVIEW").otherwise("READY")
    return a.join(F.broadcast(p)).select("pending", "unresolved", state.alias("state"))  # one row each


def capped(rows: DataFrame, key: str, identity: str, order: str, limit: int) -> DataFrame:
    """W07, H06, T06, Z12. The first ``limit`` different identities of each key in arrival order."""
    w = Window.partitionBy(key, identity).orderBy(order)
    first = rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    return first.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where(F.col("__n") <= limit).drop("__n")


def first_success(stages: DataFrame, key: str, order: str, resources: str = "resources") -> DataFrame:
    """W11, G21, Z42. Of each source the first stage that found resources, else the last."""
    hit = F.min_by("stage", F.when(F.col(resources) > 0, F.col(order)))
    return stages.groupBy(key).agg(F.coalesce(hit, F.max_by("stage", order)).alias("stage"), F.max(resources).alias("resources"))


def best_variant(variants: DataFrame, key: str, ranks: dict[str, int], order: str) -> DataFrame:
    """W12, J21. The variant of the best status (one that has no rank counts 1), the first on ties."""
    known = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair])
    rank = F.coalesce(F.try_element_at(known, F.col("status")), F.lit(1))
    return variants.groupBy(key).agg(F.min_by(F.struct(*variants.columns), F.struct(-rank, F.col(order))).alias("__r")).select("__r.*")


def host_variants(url: Column) -> Column:
    """U07, U08. Both schemes with and without www., the given form first, without repeats."""
    base, rest = U.canonical_host(url), F.regexp_extract(url, r"^[^:]+://[^/?#]*(.*)$", 1)
    forms = [F.concat(F.lit(f"{s}://{w}"), base, rest) for s in ("https", "http") for w in ("", "www.")]
    return F.array_distinct(F.array(url, *forms))


def interesting_lines(log: Column, pattern: str, last: int = 6, most: int = 2000) -> Column:
    """F37. The last lines that match, at most ``most`` characters of them."""
    hits = F.filter(F.split(T.plain_log(log), "\n"), lambda x: x.rlike(pattern))
    return F.right(F.array_join(F.slice(hits, F.greatest(F.size(hits) - last + 1, F.lit(1)), last), "\n"), F.lit(most))


def utc(value: Column) -> Column:
    """D02. A time stamp of ISO text, UTC if it names no zone; null if it is none."""
    return F.try_to_timestamp(F.trim(value))


def file_links(docs: DataFrame, key: str, body: str) -> DataFrame:
    """X16. Links (url, download_url, link) of the records of JSON bodies that name files."""
    lists = F.coalesce(*[F.get_json_object(body, f"$.{k}") for k in ("items", "data", "results", "records", "features")], F.col(body))
    records = F.explode(F.from_json(lists, "array<struct<url:string,download_url:string,link:string>>"))
    out = docs.select(key, records.alias("r")).select(key, F.coalesce("r.url", "r.download_url", "r.link").alias("link"))
    return out.where(F.col("link").isNotNull() & U.is_resource(F.col("link")))


def decode_body(content: Column, content_type: Column) -> Column:
    """X19. Text of a body by its declared charset: UTF-8, Latin-1, UTF-16; UTF-8 by default."""
    charset = F.lower(F.regexp_extract(F.coalesce(content_type, F.lit("")), r'(?i)charset="?([\w-]+)', 1))
    return F.when(charset.isin("iso-8859-1", "latin-1", "latin1", "windows-1252"), F.decode(content, "ISO-8859-1")).when(charset.startswith("utf-16"), F.decode(content, "UTF-16")).otherwise(F.decode(content, "UTF-8"))


def pagination_chain(pages: DataFrame, key: str, order: str, most_pages: int = 5, most_records: int = 5000, stagnant: int = 2) -> DataFrame:
    """G05. Pages of each API chain, given in order, with the stop rule that ends it at or before them, null while it goes on: a
    repeated URL, a change of format, a repeated payload, pages without records in a row (the first page aside), as many pages
    or records as allowed. ``api_crawl.pagination_chains`` finds the pages itself."""
    w = Window.partitionBy(key).orderBy(order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    p = pages.withColumns(
        {
            "__n": F.row_number().over(w),
            "__r": F.sum("records").over(upto),
            "__u": F.row_number().over(Window.partitionBy(key, "url").orderBy(order)),
            "__h": F.row_number().over(Window.partitionBy(key, "page_hash").orderBy(order)),
            "__f": F.first("format").over(w),
            "__s": F.sum(F.col("records")).over(w.rowsBetween(1 - stagnant, 0)),
        }
    )
    rule = (
        F.when(F.col("__u") > 1, "REPEATED_URL").when(F.col("format") != F.col("__f"), "FORMAT_CHANGED").when(F.col("__h") > 1, "REPEATED_PAYLOAD")
        .when((F.col("__n") > stagnant) & (F.col("__s") == 0), "STAGNANT").when(F.col("__n") >= most_pages, "MAX_PAGES").when(F.col("__r") >= most_records, "MAX_RECORDS")
    )
    p = p.withColumn("__rule", rule)
    return p.withColumn("stop_reason", F.first("__rule", ignorenulls=True).over(upto)).drop("__n", "__r", "__u", "__h", "__f", "__s", "__rule")


def new_checkpoint(plan: DataFrame) -> DataFrame:
    """G14. State of each planned source: PENDING if it is operational, else SKIPPED_STATUS; no attempts."""
    return plan.select("source_id", F.when(F.col("next_phase") == "OPERATIONAL_CONFIG", "PENDING").otherwise("SKIPPED_STATUS").alias("state"), F.lit(0).alias("attempts"))


def conditional_headers(fetches: DataFrame, order: str) -> DataFrame:
    """G17. The latest known etag and Last-Modified of each URL."""
    known = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order)))
    return fetches.groupBy("url").agg(known("etag").alias("etag"), known("last_modified").alias("last_modified"))


def host_schedule(requests: DataFrame, order: str, intervals: DataFrame) -> DataFrame:
    """G19, Z06. Earliest start of each request: a host's requests keep the largest interval that any source asks for."""
    gap = intervals.groupBy("host").agg(F.max("interval_s").alias("__gap"))
    r = requests.join(F.broadcast(gap), "host", "left").withColumn("__gap", F.coalesce("__gap", F.lit(0.0)))
    n = F.row_number().over(Window.partitionBy("host").orderBy("at_s", order))
    ready = F.max(F.col("at_s") - F.col("__gap") * F.col("__n")).over(Window.partitionBy("host").orderBy("__n"))
    return r.withColumn("__n", n).withColumn("start_s", ready + F.col("__gap") * F.col("__n")).drop("__n", "__gap")


def final_attempt(attempts: DataFrame, key: str, retryable: list[int], most: int = 3) -> DataFrame:
    """G20. The attempt that a retry loop would return: the first that is not retryable, else the last allowed."""
    w = Window.partitionBy(key).orderBy("attempt")
    a = attempts.where(F.col("attempt") <= most).withColumn("__again", F.col("status").isNull() | F.col("status").isin(*retryable))
    return a.groupBy(key).agg(F.coalesce(F.min_by("status", F.when(~F.col("__again"), F.col("attempt"))), F.max_by("status", "attempt")).alias("status"), F.coalesce(F.min(F.when(~F.col("__again"), F.col("attempt"))), F.max("attempt")).alias("attempts"))


def headers(*parts: Column) -> Column:
    """Z05. Header maps merged, names in lower case, later ones win."""
    entries = F.concat(*[F.map_entries(F.transform_keys(p, lambda k, _: F.lower(k))) for p in parts])
    return F.aggregate(entries, F.create_map().cast("map<string,string>"), lambda acc, e: F.map_concat(F.map_filter(acc, lambda k, _: k != e["key"]), F.map_from_arrays(F.array(e["key"]), F.array(e["value"]))))


def default_sitemap(url: Column) -> Column:
    """Z08."""
    return F.concat(U.scheme(url), F.lit("://"), U.netloc(url), F.lit("/sitemap.xml"))


def open_links(links: DataFrame, stopped: DataFrame) -> DataFrame:
    """Z09, Z10. Links outside the pagination families that have stopped."""
    s = stopped.select(F.col("family").alias("__f")).distinct()
    return links.withColumn("__g", U.pagination_family(F.col("url"))).join(s, F.col("__g") == F.col("__f"), "left_anti").drop("__g")


def identity_keys(*values: Column) -> Column:
    """Z22, Z62. Lower-case identities without closing slashes, blanks or repeats."""
    return F.array_distinct(F.filter(F.transform(F.array(*values), lambda v: U.entrypoint(F.lower(F.trim(v)))), lambda v: v.isNotNull() & (v != "")))


def mapping_report(plan: DataFrame, matches: DataFrame) -> DataFrame:
    """Z24, J05. Each planned source with OK, MISSING, AMBIGUOUS or UNEXPECTED (a match that must not be)."""
    m = matches.groupBy("source_id").agg(F.count("*").alias("__n"))
    n, due = F.coalesce("__n", F.lit(0)), F.col("operational")
    return plan.join(m, "source_id", "left").select("source_id", F.when(due & (n == 0), "MISSING").when(due & (n > 1), "AMBIGUOUS").when(~due & (n > 0), "UNEXPECTED").otherwise("OK").alias("outcome"))


def probe_level(artifacts: Column, logged: Column) -> Column:
    """Z39, Z40. (resources, level): the larger count; L1 with artifacts, L0 with log evidence only, NEG with neither."""
    n = F.greatest(F.coalesce(artifacts, F.lit(0)), F.coalesce(logged, F.lit(0)))
    return F.struct(n.alias("resources"), F.when(F.coalesce(artifacts, F.lit(0)) > 0, "L1").when(n > 0, "L0").otherwise("NEG").alias("level"))


def form_queries(forms: DataFrame, limit: int = 8) -> DataFrame:
    """Z34. GET URLs of forms (page_url, action, method, fields: array of (name, type, value)): same site, no passwords,
    files or buttons, at most ``limit`` of each page."""
    usable = F.filter("fields", lambda f: (f["name"] != "") & ~F.lower(F.coalesce(f["type"], F.lit("text"))).isin("password", "file", "submit", "button", "image", "reset"))
    q = F.array_join(F.transform(usable, lambda f: F.concat(F.url_encode(f["name"]), F.lit("="), F.url_encode(F.coalesce(f["value"], F.lit(""))))), "&")
    out = forms.where(F.upper(F.coalesce("method", F.lit("GET"))) == "GET").withColumn("url", F.concat(U.join(F.col("page_url"), F.col("action")), F.lit("?"), q))
    out = out.where(U.same_site(F.col("url"), F.col("page_url")))
    return out.withColumn("__n", F.row_number().over(Window.partitionBy("page_url").orderBy("url"))).where(F.col("__n") <= limit).select("page_url", "url")


def slowest(runs: DataFrame, seconds: str, key: str, k: int = 10) -> DataFrame:
    """T01, T03."""
    return runs.orderBy(F.col(seconds).desc(), key).limit(k)


def folded_lookup(rows: DataFrame, inventory: DataFrame, key: str, inventory_key: str = "source_id") -> DataFrame:
    """J18. Rows with the inventory's columns by their keys without regard to case; of inventory rows that differ in case alone the
    greatest id counts; null and empty keys find nothing."""
    right = inventory.where(F.coalesce(F.col(inventory_key), F.lit("")) != "").groupBy(F.lower(inventory_key).alias("__folded"))
    rest = [c for c in inventory.columns if c not in rows.columns and c != inventory_key]
    right = right.agg(F.max_by(F.struct(*rest, F.col(inventory_key).alias("inventory_id")), inventory_key).alias("__r"))
    return rows.withColumn("__key", F.lower(key)).join(right, F.col("__key") == F.col("__folded"), "left").select(*rows.columns, "__r.*")


def resolve_candidates(candidates: DataFrame, probes: DataFrame, policies: DataFrame, identities: DataFrame) -> DataFrame:
    """J10. Each custom candidate (source_id) with its probe (status, endpoints, seeds; needed), its policy (policy_status,
    form_confirmed) and its identity (identity_status, candidate_entrypoint), resolved by C13. A candidate without a probe has the
    error MISSING_PROBE."""
    from . import rules as R
    from .audit import unique_rows

    out = candidates.select("source_id").join(unique_rows(probes.select("source_id", "status", "endpoints", "seeds"), "source_id").withColumn("__p", F.lit(True)), "source_id", "left")
    out = out.join(unique_rows(policies.select("source_id", "policy_status", "form_confirmed"), "source_id"), "source_id", "left").join(unique_rows(identities.select("source_id", "identity_status", "candidate_entrypoint"), "source_id"), "source_id", "left")
    s = R.custom_resolution(*[F.col(c) for c in ("status", "policy_status", "endpoints", "seeds", "form_confirmed", "identity_status", "candidate_entrypoint")])
    return out.select("source_id", "__p", s.alias("s")).select("source_id", "s.resolution_status", "s.workflow_strategy", "s.next_phase", "s.entrypoint_override", F.when(F.col("__p").isNull(), "MISSING_PROBE").otherwise(F.col("s.error")).alias("error"))
