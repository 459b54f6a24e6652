"""Crawl frontier operators: admission, caps in arrival order, breadth-first levels, redirects, robots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..sources.shared import store
from .scan import ranked_variants, running


def trap(url: Column, max_length: int = 2048, max_keys: int = 12) -> Column:
    """F55, the stateless reasons: URL_TOO_LONG, TOO_MANY_QUERY_KEYS, REPEATED_PATH_SEGMENTS, or null."""
    return F.when(F.length(url) > max_length, "URL_TOO_LONG").when(F.size(U.pairs(url)) > max_keys, "TOO_MANY_QUERY_KEYS").when(U.repeated_segments(U.path(url)), "REPEATED_PATH_SEGMENTS")


def first_seen(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """W13. The first row of each key in arrival order."""
    return df.groupBy(*key).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("__r")).select("__r.*")


def variant_number(df: DataFrame, family: Column, variant: Column, order: list[str], name: str) -> DataFrame:
    """Rank of each row's variant within its family by the variant's first arrival."""
    df = df.withColumn("__f", family).withColumn("__v", variant)
    out = ranked_variants(df, ["__f"], ["__v"], order, name)
    return out.withColumn(name, F.col(name).cast("int")).drop("__f", "__v")


def admit(links: DataFrame, hosts: DataFrame, order: str = "ord", max_depth: int = 2, max_variants: int = 25, max_dates: int = 36, max_urls: int = 250) -> DataFrame:
    """F52. Links (source_id, url, depth, arrival order) with admitted and reason, after the order of the checks: depth,
    scheme, scope, traps (calendar variants count even if a later check refuses), duplicates (refused without a reason),
    query variants, the cap on URLs. Hosts: (source_id, host) in scope. Caps count by scans: a source with most of the links spreads
    over tasks. The order must be total within a source."""
    l = links.withColumn("nurl", U.normalize(F.col("url"))).withColumn("host", U.host(F.col("nurl")))
    scope = hosts.select("source_id", "host", F.lit(True).alias("__in")).distinct()
    l = l.join(scope, ["source_id", "host"], "left")
    early = (
        F.when(F.col("depth") > max_depth, "MAX_DEPTH")
        .when(~U.scheme(F.col("nurl")).isin("http", "https"), "INVALID_OR_UNSUPPORTED_URL")
        .when(F.col("__in").isNull(), "OUT_OF_SCOPE_HOST")
        .otherwise(F.concat(F.lit("SPIDER_TRAP:"), trap(F.col("nurl"))))
    )
    l = store(l.withColumn("reason", early))
    open_ = F.col("reason").isNull()
    cal = U.calendar_family(F.col("nurl"))
    dated = l.withColumn("__c", F.when(open_, cal))
    dated = variant_number(dated, F.concat_ws("|", "source_id", F.col("__c")["template"]), F.col("__c")["value"], [order], "__date_no")
    dated = dated.withColumn("reason", F.when(open_ & F.col("__c").isNotNull() & (F.col("__date_no") > max_dates), "SPIDER_TRAP:CALENDAR_VARIANT_LIMIT").otherwise(F.col("reason")))
    dated = store(dated)
    first = dated.where(open_).groupBy("source_id", "nurl").agg(F.min(order).alias("__first"))
    dated = store(dated.join(first, ["source_id", "nurl"], "left").withColumn("__copy", open_ & (F.col(order) > F.col("__first"))).drop("__first"))
    fresh = open_ & ~F.col("__copy")
    q = variant_number(dated.withColumn("__fresh", fresh), F.concat_ws("|", "source_id", F.col("__fresh").cast("string"), U.query_family(F.col("nurl"))), U.query(F.col("nurl")), [order], "__variant_no")
    limited = F.col("__fresh") & (U.query(F.col("nurl")) != "") & (F.col("__variant_no") > max_variants)
    q = q.withColumn("reason", F.when(limited, "QUERY_VARIANT_LIMIT").otherwise(F.col("reason")))
    ok = F.col("__fresh") & F.col("reason").isNull()
    q = running(store(q.withColumn("__ok", ok.cast("long"))), ["source_id"], [order], {"__place": ("sum", "__ok")}, store)
    q = q.withColumn("reason", F.when((F.col("__ok") > 0) & (F.col("__place") > max_urls), "MAX_URLS").otherwise(F.col("reason")))
    return q.withColumn("admitted", F.col("__fresh") & F.col("reason").isNull()).drop("__in", "__c", "__date_no", "__copy", "__fresh", "__variant_no", "__ok", "__place")


def bfs_levels(edges: DataFrame, seeds: DataFrame, max_depth: int, checkpoint=None) -> DataFrame:
    """G01. (url, depth) of the URLs reachable from seeds over edges (parent, child) within max_depth links. One
    distributed join for each level; ``checkpoint`` (DataFrame -> DataFrame) cuts the lineage."""
    checkpoint = checkpoint or (lambda df: df)
    seen = checkpoint(seeds.select("url").distinct().withColumn("depth", F.lit(0)))
    level = seen
    for depth in range(1, max_depth + 1):
        reached = level.join(edges, level.url == edges.parent).select(F.col("child").alias("url")).distinct()
        level = checkpoint(reached.join(seen, "url", "left_anti").withColumn("depth", F.lit(depth)))
        seen = seen.union(level)
    return seen


def stop_reason(queue_left: Column, urls: Column, runtime: Column, requests: Column, errors: Column, max_urls: int = 250, max_runtime: float = 900.0, max_requests: int = 250, max_errors: int = 5) -> Column:
    """G08, the first that holds."""
    return F.when(runtime >= max_runtime, "MAX_RUNTIME").when(requests >= max_requests, "REQUEST_BUDGET_REACHED").when(errors >= max_errors, "MAX_CONSECUTIVE_ERRORS").when(urls >= max_urls, "MAX_URLS").when(queue_left == 0, "QUEUE_EXHAUSTED")


# Fixed values.
REDIRECTS = [301, 302, 303, 307, 308]


def redirect_chain(responses: DataFrame, starts: DataFrame, max_redirects: int = 5) -> DataFrame:
    """Z01. (start, url, status, method, redirects, outcome) of requests followed by hand over captured responses.

    responses: (url, status, location, error); starts: (url; optionally method, hosts: array of hosts in scope, budget: requests).
    Outcomes: FINAL, REDIRECT_LOOP, REDIRECT_OUT_OF_SCOPE (the start or a target), REQUEST_BUDGET_EXCEEDED (each hop is a request),
    REDIRECT_LOCATION_MISSING, TOO_MANY_REDIRECTS, INVALID_REDIRECT_URL, the response's error, or NOT_CAPTURED. A 303 turns every
    method but HEAD into GET. One join for each hop; redirects of one URL repeated count once."""
    given = lambda c, t: F.col(c) if c in starts.columns else F.lit(None).cast(t).alias(c)
    at = starts.select(F.col("url").alias("start"), "url", F.coalesce(F.upper(given("method", "string")), F.lit("GET")).alias("method"), given("hosts", "array<string>"), given("budget", "int"))
    at = at.withColumns({"seen": F.array().cast("array<string>"), "redirects": F.lit(0), "status": F.lit(None).cast("int"), "outcome": F.lit(None).cast("string")})
    r = responses.groupBy("url").agg(F.min(F.struct(F.col("status").cast("int").alias("status"), "location", "error")).alias("r"), F.lit(True).alias("known"))
    r = r.select(F.col("url").alias("__at"), "r", "known")
    scope = lambda u: F.col("hosts").isNotNull() & ~F.array_contains("hosts", U.host(u))
    for hop in range(max_redirects + 1):
        at = store(at) if hop else at
        n = at.join(r, F.col("url") == F.col("__at"), "left")
        code, place = F.col("r.status"), F.nullif(F.col("r.location"), F.lit(""))
        target = F.when(place.isNotNull(), U.join(F.col("url"), place))
        n = n.withColumn("target", target)
        early = F.when(F.array_contains("seen", F.col("url")), "REDIRECT_LOOP").when(scope(F.col("url")), "REDIRECT_OUT_OF_SCOPE").when(F.col("budget") <= F.size("seen"), "REQUEST_BUDGET_EXCEEDED")
        answer = F.when(F.col("known").isNull(), "NOT_CAPTURED").when(F.col("r.error").isNotNull(), F.col("r.error")).when(~F.coalesce(code.isin(*REDIRECTS), F.lit(False)), "FINAL")
        late = (
            F.when(place.isNull(), "REDIRECT_LOCATION_MISSING").when(F.col("redirects") >= max_redirects, "TOO_MANY_REDIRECTS")
            .when(~U.scheme(F.col("target")).isin("http", "https") | (U.host(F.col("target")) == ""), "INVALID_REDIRECT_URL").when(scope(F.col("target")), "REDIRECT_OUT_OF_SCOPE")
        )
        n = n.withColumns({"__early": early, "__new": F.coalesce(early, answer, late)})
        live, go = F.col("outcome").isNull(), F.col("outcome").isNull() & F.col("__new").isNull()
        method = F.when(go & (code == 303) & (F.col("method") != "HEAD"), "GET").otherwise(F.col("method"))
        at = n.select(
            "start", F.when(go, F.col("target")).otherwise(F.col("url")).alias("url"), method.alias("method"), "hosts", "budget", F.when(go, F.concat("seen", F.array("url"))).otherwise(F.col("seen")).alias("seen"),
            (F.col("redirects") + go.cast("int")).alias("redirects"), F.when(live, F.when(F.col("__early").isNull() & ~go, code)).otherwise(F.col("status")).alias("status"), F.coalesce("outcome", "__new").alias("outcome"),
        )
    return at.select("start", "url", "status", "method", "redirects", "outcome")


def robots_kind(status: Column) -> Column:
    """S06. rules (2xx), unavailable (4xx but 429: all is allowed), else unreachable."""
    return F.when(status.between(200, 299), "rules").when(status.between(400, 499) & (status != 429), "unavailable").otherwise("unreachable")


def robots_sitemaps(text: Column) -> Column:
    """S07. Distinct sitemap lines in order, the key in any case."""
    lines = F.split(text, r"\r?\n")
    found = F.filter(lines, lambda x: F.lower(x).rlike(r"^\s*sitemap\s*:"))
    return F.array_distinct(F.filter(F.transform(found, lambda x: F.trim(F.regexp_replace(x, r"^\s*\w+\s*:", ""))), lambda x: x != ""))


def robots_entries(text: Column) -> Column:
    """Groups of a robots file: agents and rules (allow, path) in order; a blank line ends a group, and an agent after rules
    begins one. An empty Disallow allows all."""
    rule = "struct<allow:boolean,path:string>"
    empty = F.struct(F.lit(0).alias("state"), F.array().cast("array<string>").alias("agents"), F.array().cast(f"array<{rule}>").alias("rules"), F.array().cast(f"array<struct<agents:array<string>,rules:array<{rule}>>>").alias("done"))

    def step(acc, raw):
        def of(x):
            acc, line = x["acc"], F.trim(F.regexp_replace(x["raw"], r"#.*$", ""))
            key, value = F.lower(F.trim(F.substring_index(line, ":", 1))), U.unquote(F.trim(F.regexp_replace(line, r"^[^:]*:", "")))
            pair, known = F.contains(line, F.lit(":")), acc["state"] != 0
            agent, rule_ = pair & (key == "user-agent"), pair & key.isin("allow", "disallow") & known
            other = pair & key.isin("crawl-delay", "request-rate") & known
            blank = x["raw"] == ""
            closes = (acc["state"] == 2) & (blank | agent)
            fresh = (blank & known) | (agent & (acc["state"] == 2))
            agents = F.when(fresh, F.array().cast("array<string>")).otherwise(acc["agents"])
            rules = F.when(fresh, F.array().cast(f"array<{rule}>")).otherwise(acc["rules"])
            added = F.array(F.struct(((key == "allow") | (value == "")).alias("allow"), value.alias("path")))
            return F.struct(
                F.when(blank, 0).when(agent, 1).when(rule_ | other, 2).otherwise(acc["state"]).alias("state"), F.when(agent, F.concat(agents, F.array(value))).otherwise(agents).alias("agents"),
                F.when(rule_, F.concat(rules, added)).otherwise(rules).alias("rules"), F.when(closes, F.concat(acc["done"], F.array(F.struct(acc["agents"].alias("agents"), acc["rules"].alias("rules"))))).otherwise(acc["done"]).alias("done"),
            )

        return U.let(F.struct(acc.alias("acc"), raw.alias("raw")), of)

    lines = F.split(F.concat(F.regexp_replace(F.coalesce(text, F.lit("")), r"\r\n?", "\n"), F.lit("\n\n")), "\n")  # closing blank lines end the last group
    return F.aggregate(lines, empty, step, lambda acc: acc["done"])


def robots_allowed(url: Column, entries: Column, agent: Column) -> Column:
    """F64. The first group that names the agent (a part of its name without version, in any case), else the first of ``*``;
    there the first rule whose path begins the URL's path and query decides; no rule allows. Not the longest match."""
    token = F.lower(F.substring_index(agent, "/", 1))
    named = F.filter(entries, lambda e: ~F.array_contains(e["agents"], "*") & F.exists(e["agents"], lambda a: F.contains(token, F.lower(a))))
    every = F.filter(entries, lambda e: F.array_contains(e["agents"], "*"))
    place = F.concat(U.path(url), F.when(U.query(url) != "", F.concat(F.lit("?"), U.query(url))).otherwise(""))
    place = U.unquote(F.when(place == "", F.lit("/")).otherwise(place))
    rules = F.coalesce(F.try_element_at(named, F.lit(1)), F.try_element_at(every, F.lit(1)))["rules"]
    hit = U.let(place, lambda p: F.try_element_at(F.filter(rules, lambda r: (r["path"] == "*") | F.startswith(p, r["path"])), F.lit(1)))
    return F.coalesce(hit["allow"], F.lit(True))


def robots_decision(status: Column, text: Column, url: Column, agent: Column, ignore: Column, reason: Column) -> Column:
    """F64. (allowed, code) of a URL by its host's robots file; to ignore it needs a reason that is not blank."""
    web = U.scheme(url).isin("http", "https") & (U.host(url) != "")
    kind, stated = robots_kind(status), F.trim(F.coalesce(reason, F.lit(""))) != ""
    code = (
        F.when(~web, "INVALID_URL").when(ignore, F.when(stated, "ROBOTS_OVERRIDE").otherwise("ROBOTS_OVERRIDE_REASON_REQUIRED")).when(kind == "unavailable", "ROBOTS_UNAVAILABLE_ALLOW").when(kind == "unreachable", "ROBOTS_UNREACHABLE")
        .when(robots_allowed(url, robots_entries(text), agent), "ROBOTS_ALLOWED").otherwise("ROBOTS_DISALLOWED")
    )
    return U.let(code, lambda c: F.struct(c.isin("ROBOTS_OVERRIDE", "ROBOTS_UNAVAILABLE_ALLOW", "ROBOTS_ALLOWED").alias("allowed"), c.alias("code")))
