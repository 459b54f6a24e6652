"""API crawl over captured responses: seeds, pagination chains, documentation queue, budgets and stop reasons, of many sources at
once. Each round of the fixpoint is one join of all sources' open chains (or documents) with the responses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import api as A
from ..functions import html as H
from ..functions import urls as U
from ..sources.shared import spread
from ..sources.shared import store as to_shared
from .scan import numbered

# Formats that a seed is catalogued with, those with pages, and those that a type may promise in vain.
SEED_FORMATS = ["json", "geojson", "xml", "csv", "tsv", "ndjson", "jsonstat", "topojson"]
PAGED_FORMATS = ["json", "geojson"]
PROMISED = ["json", "geojson", "openapi", "topojson", "ndjson"]
LIMITS = {"max_requests": 250, "max_endpoints": 200, "max_pages": 5, "max_records": 5000, "max_stagnant": 2, "max_documents": 8, "max_document_depth": 1}
NO_STRINGS = "array<string>"


def read_responses(responses: DataFrame, store: Callable = to_shared) -> DataFrame:
    """Captured responses (url in normal form, error, body, content_type, link) with what the crawl asks of them, made once for
    each (of repeated URLs for the least response): format, declared format, records, page hash, pages or not, next page, OpenAPI operations (refs), links to APIs
    and to specifications (specs), as identities and URLs in page order."""
    body, kind = F.col("body"), F.col("content_type")
    ok = F.col("error").isNull() & body.isNotNull()
    r = spread(store(responses.select("url", "error", "content_type", "body", "link")), "url").groupBy("url").agg(F.min(F.struct("error", "content_type", "body", "link")).alias("r")).select("url", "r.*")
    r = r.withColumn("body", F.when(ok, body)).withColumn("format", A.detect_format(body, kind))
    r = r.withColumn("declared", A.declared_format(kind, F.col("url"))).withColumn("records", F.coalesce(A.records(body, F.col("format")), F.lit(0)))
    # made where the rows lie, spread: a table of these to join again would be dealt twice, by its few bytes
    data = F.col("format").isin(*SEED_FORMATS)
    made = {"hash": A.page_hash(F.when(data, body), F.col("format")), "paged": F.when(data, A.has_pagination(body, F.col("url"))), "next": F.when(data, A.next_page(body, F.col("link"), F.col("url")))}
    r = store(r.withColumns(made))
    ops = A.openapi_operations(r.where("format = 'openapi'").select("url", "body")).withColumn("ref", U.api_identity(F.lit("GET"), U.normalize(F.col("url_of_operation"))))
    ops = ops.groupBy("url").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "ref"))), lambda x: x["ref"]).alias("ops"))
    pages = r.where("format IS NULL AND body IS NOT NULL").select("url", F.col("body").alias("html"))
    found = H.links(pages).select("url", F.lit(0).alias("pass"), "ord", "link").union(H.api_references(pages).select("url", F.lit(1), "ord", "link"))
    found = found.where(A.is_api_url(F.col("link"))).withColumn("spec", A.is_openapi_url(F.col("link"))).withColumn("ref", U.api_identity(F.lit("GET"), F.col("link")))
    found = found.groupBy("url", "ref").agg(F.min(F.struct("pass", "ord", "link", "spec", "ref")).alias("x")).groupBy("url").agg(F.array_sort(F.collect_list("x")).alias("links"))
    out = r.withColumn("ok", ok).drop("body", "link", "content_type")
    extra = ops.withColumn("links", F.lit(None).cast(found.schema["links"].dataType)).unionByName(found.withColumn("ops", F.lit(None).cast(NO_STRINGS)))  # a response is of one kind
    return store(out.join(extra, "url", "left"))


def _limit(sources: DataFrame, name: str) -> Column:
    return F.col(name) if name in sources.columns else F.lit(LIMITS[name]).alias(name)


def pagination_chains(firsts: DataFrame, responses: DataFrame, store: Callable = to_shared) -> tuple[DataFrame, DataFrame]:
    """G05. The pages that follow each chain's first one: (attempts, chains).

    firsts: (chain, url, follow, max_pages, max_records, max_stagnant) with the first response's format, hash, records, next. The
    loop asks, in this order: as many pages as allowed (MAX_PAGES); as many records (MAX_RECORDS); no acceptable next page
    (its reason); a URL of the chain again (REPEATED_URL); then it fetches: an error (FETCH_ERROR), another format (FORMAT_CHANGED),
    a payload of the chain again (REPEATED_PAYLOAD); a page counts, and after max_stagnant pages without records in a row,
    the first page aside, the chain is STAGNANT. attempts: (chain, step from 2, url, error, counted, records, hash); chains:
    (chain, pages, records, strategy, stop)."""
    n = F.col("max_pages")
    at = firsts.select(
        "chain", "max_pages", "max_records", "max_stagnant", "format", "next", F.lit(1).alias("pages"), F.col("records").alias("total"), F.lit(0).alias("stagnant"),
        F.array("url").alias("urls"), F.array("hash").alias("hashes"), F.lit(None).cast("string").alias("strategy"), F.when(~F.col("follow"), "NOT_PAGED").when(n <= 1, "MAX_PAGES").alias("stop"),
    )
    at = store(at)
    page = responses.select(F.col("url").alias("target"), "error", "ok", F.col("format").alias("f"), F.col("records").alias("r"), F.col("hash").alias("h"), F.col("next").alias("following"))
    most = firsts.agg(F.max("max_pages")).first()[0] or 1
    attempts, ended = None, at.where("stop IS NOT NULL")
    for step in range(2, most + 1):
        refused = F.when(F.col("total") >= F.col("max_records"), "MAX_RECORDS").when(F.col("next.next_url").isNull(), F.col("next.reason")).when(F.array_contains("urls", F.col("next.next_url")), "REPEATED_URL")
        at = at.where("stop IS NULL").withColumn("stop", refused)
        ended = ended.union(at.where("stop IS NOT NULL"))
        go = at.where("stop IS NULL").withColumn("strategy", F.coalesce("strategy", "next.strategy")).withColumn("target", F.col("next.next_url"))
        got = go.join(page, "target", "left")
        bad = F.when(~F.coalesce("ok", F.lit(False)), "FETCH_ERROR").when(~F.col("f").eqNullSafe(F.col("format")), "FORMAT_CHANGED").when(F.array_contains("hashes", F.col("h")), "REPEATED_PAYLOAD")
        got = store(got.withColumn("bad", bad).withColumn("error", F.when(~F.coalesce("ok", F.lit(False)), F.coalesce("error", F.lit("NOT_CAPTURED")))))
        tried = got.select("chain", F.lit(step).alias("step"), F.col("target").alias("url"), "error", F.col("bad").isNull().alias("counted"), F.when(F.col("bad").isNull(), F.col("r")).otherwise(0).alias("records"), F.col("h").alias("hash"))
        attempts = tried if attempts is None else attempts.union(tried)
        fine = F.col("bad").isNull()
        idle = F.when(F.col("r") == 0, F.col("stagnant") + 1).otherwise(0)
        at = got.select(
            "chain", "max_pages", "max_records", "max_stagnant", "format", F.when(fine, F.col("following")).alias("next"), F.when(fine, F.col("pages") + 1).otherwise(F.col("pages")).alias("pages"),
            F.when(fine, F.col("total") + F.col("r")).otherwise(F.col("total")).alias("total"), F.when(fine, idle).otherwise(F.col("stagnant")).alias("stagnant"), F.concat("urls", F.array("target")).alias("urls"),
            F.when(fine, F.concat("hashes", F.array("h"))).otherwise(F.col("hashes")).alias("hashes"), "strategy",
            F.coalesce("bad", F.when(idle >= F.col("max_stagnant"), "STAGNANT"), F.when(F.col("pages") + 1 >= n, "MAX_PAGES")).alias("stop"),
        )
        ended = ended.union(at.where("stop IS NOT NULL"))
    none = firsts.select("chain", F.lit(0).alias("step"), "url", F.lit(None).cast("string").alias("error"), F.lit(False).alias("counted"), F.lit(0).cast("long").alias("records"), "hash").where("false")
    return none if attempts is None else none.union(attempts), ended.select("chain", "pages", F.col("total").alias("records"), "strategy", "stop")


def _folded(events: DataFrame, start: Column) -> Column:
    """Keys catalogued after each source's events (before, need, refs, more, limited) in order; see ``api_crawl``."""

    def step(acc, e):
        stop = F.when(e["seed"] & (F.size(acc["keys"]) >= e["max_endpoints"]), "MAX_API_ENDPOINTS").when(e["before"] >= e["max_requests"], "REQUEST_BUDGET_EXCEEDED")
        own = F.array_union(acc["keys"], e["first"])  # a document's own identity takes its place before its operations do
        refs = F.when(e["limited"], F.slice(e["refs"], 1, F.greatest(F.lit(0), e["max_endpoints"] - F.size(own)))).otherwise(e["refs"])
        keys = F.array_union(F.array_union(own, refs), e["more"])
        done = acc["stop"].isNotNull()
        return F.struct(F.when(done | stop.isNotNull(), acc["keys"]).otherwise(keys).alias("keys"), F.when(done | stop.isNotNull(), acc["begun"]).otherwise(acc["begun"] + 1).alias("begun"), F.coalesce(acc["stop"], stop).alias("stop"))

    return F.aggregate(events, start, step)


def api_crawl(sources: DataFrame, responses: DataFrame, store: Callable = to_shared, documents: bool = True) -> dict[str, DataFrame]:
    """G04, G06, Z13. What crawling each source's API seeds would do, against captured responses.

    sources: (source_id, seeds: array of URLs; optionally max_requests, max_endpoints, max_pages, max_records, max_stagnant,
    max_documents, max_document_depth). responses: (url, error, body, content_type, link). A URL without a response fails as
    NOT_CAPTURED. Seeds are taken in order until a source has max_endpoints API identities (MAX_API_ENDPOINTS) or has used
    its requests (REQUEST_BUDGET_EXCEEDED), else API_SEEDS_EXHAUSTED. A seed is a specification (its operations are
    catalogued, as far as identities are left), data (an identity, and its pages), or a page (its links to APIs as far as
    identities are left, its specifications all; these are queued). The queue is taken breadth-first to max_document_depth, each
    URL once, at most max_documents and as far as requests are left; pages found there queue their specifications one level deeper.

    A seed's pages do not depend on other seeds but for the budget, which cuts the attempts of a source, in order, after its last
    request: chains are followed for all seeds at once, attempts numbered by a scan, and cut. Only the identities
    of a source (at most its limit, and what one page names) meet in one row.

    Returns ``sources`` (coverage, stop_reason, success, failure_code), ``seeds`` (outcome, pages, records, strategy, stop),
    ``attempts`` (each request: phase, url, error) and ``resources`` (source_id, place, identity). A source without seeds
    succeeds with nothing. Repeated seeds are seeds of their own. Null seeds are left out. Without ``documents`` only ``seeds``
    is made: the queue comes after all seeds and changes none of them.
    """
    r = read_responses(responses, store)
    conf = sources.select("source_id", "seeds", *[_limit(sources, k) for k in LIMITS])
    seeds = conf.select("*", F.posexplode(F.filter(F.coalesce("seeds", F.array().cast(NO_STRINGS)), lambda s: s.isNotNull())).alias("seed_no", "seed")).drop("seeds").withColumn("url", U.normalize(F.col("seed")))
    s = seeds.join(r.withColumn("known", F.lit(True)), "url", "left").withColumn("error", F.when(F.col("known").isNull(), "NOT_CAPTURED").otherwise(F.coalesce("error", F.when(~F.col("ok"), "API_EMPTY"))))
    outcome = (
        F.when(F.col("error") == "RESPONSE_TOO_LARGE", "TOO_LARGE").when(F.col("error").isNotNull(), "FAILED")
        .when(F.col("format").isNull() & F.col("declared").isin(*PROMISED), "INVALID_RESPONSE").when(F.col("format") == "openapi", "OPENAPI").when(F.col("format").isin(*SEED_FORMATS), "DATA").otherwise("PAGE")
    )
    s = store(s.withColumn("outcome", outcome).withColumn("identity", U.api_identity(F.lit("GET"), F.col("url"))).withColumn("chain", F.struct("source_id", "seed_no")))

    # an identity that an earlier seed has shown to be paged stays so; seeds are configuration, a source's are few
    known = F.max(F.col("paged") & (F.col("outcome") == "DATA")).over(Window.partitionBy("source_id", "identity").orderBy("seed_no"))
    data = s.withColumn("follow", F.coalesce(known, F.lit(False)) & F.col("format").isin(*PAGED_FORMATS)).where("outcome = 'DATA'")
    tried, chains = pagination_chains(data.select("chain", "url", "follow", "max_pages", "max_records", "max_stagnant", "format", "hash", "records", "next"), r, store)
    first = s.select("source_id", "seed_no", F.lit(1).alias("step"), "url", "error", (F.col("outcome") == "DATA").alias("counted"), F.when(F.col("outcome") == "DATA", F.col("records")).otherwise(0).alias("records"))
    every = first.union(tried.select("chain.source_id", "chain.seed_no", "step", "url", "error", "counted", "records"))
    every = store(numbered(store(every), ["source_id"], ["seed_no", "step"], "request_no", store))

    begin = every.where("step = 1").select("source_id", "seed_no", (F.col("request_no") - 1).alias("before"))
    empty = F.array().cast(NO_STRINGS)
    cut = lambda c: F.slice(c, 1, F.greatest(F.col("max_endpoints"), F.lit(0)))
    links = F.coalesce(F.transform("links", lambda x: x["ref"]), empty)
    specs = F.filter(F.coalesce("links", F.expr("array()")), lambda x: x["spec"])
    event = F.struct(
        "seed_no", F.lit(True).alias("seed"), "before", "max_requests", "max_endpoints", F.col("outcome").isin("OPENAPI", "PAGE").alias("limited"), F.lit(None).cast(NO_STRINGS).alias("none"),
        F.when(F.col("outcome") == "OPENAPI", cut(F.coalesce("ops", empty))).when(F.col("outcome") == "PAGE", cut(links)).when(F.col("outcome").isin("DATA", "TOO_LARGE"), F.array("identity")).otherwise(empty).alias("refs"),
        F.when(F.col("outcome") == "PAGE", F.coalesce(F.transform(specs, lambda x: x["ref"]), empty)).otherwise(empty).alias("more"), empty.alias("first"),
    )
    start = F.struct(empty.alias("keys"), F.lit(0).alias("begun"), F.lit(None).cast("string").alias("stop"))
    per = s.join(begin, ["source_id", "seed_no"]).groupBy("source_id").agg(F.array_sort(F.collect_list(event)).alias("events"))
    per = per.select("source_id", _folded(F.col("events"), start).alias("a"))
    per = store(conf.drop("seeds").join(per, "source_id", "left").select("*", F.coalesce("a.begun", F.lit(0)).alias("begun"), F.coalesce("a.keys", empty).alias("keys"), F.col("a.stop").alias("stop_reason")).drop("a"))

    limits = per.select("source_id", "begun", "max_requests")
    done = store(every.join(limits, "source_id").where("seed_no < begun AND request_no <= max_requests").drop("begun", "max_requests"))
    used = done.groupBy("source_id").agg(F.count("*").alias("used"))
    last = done.groupBy("source_id", "seed_no").agg(F.max("request_no").alias("last"), F.count_if("counted").alias("pages"), F.sum("records").alias("records"), F.max("step").alias("steps"))
    whole = every.groupBy("source_id", "seed_no").agg(F.max("step").alias("all_steps"))
    out_seeds = s.select("source_id", "seed_no", "seed", "url", "outcome", "format", "identity", "chain", "error", "max_requests", "max_pages").join(limits.drop("max_requests"), "source_id").where("seed_no < begun")
    out_seeds = out_seeds.join(last, ["source_id", "seed_no"]).join(whole, ["source_id", "seed_no"]).join(chains.select("chain", "strategy", "stop"), "chain", "left")
    # at the head of the loop the budget is asked before records and the next page
    spent = (F.col("last") >= F.col("max_requests")) & ((F.col("steps") < F.col("all_steps")) | ~F.col("stop").isin("NOT_PAGED", "MAX_PAGES", "FETCH_ERROR", "FORMAT_CHANGED", "REPEATED_PAYLOAD", "STAGNANT"))
    out_seeds = out_seeds.withColumn("stop", F.when(spent & F.col("stop").isNotNull(), "REQUEST_BUDGET").otherwise(F.col("stop")))
    out_seeds = store(out_seeds.select("source_id", "seed_no", "url", "outcome", "format", "identity", "error", "pages", "records", F.when(F.col("pages") > 0, F.when(F.col("steps") > 1, F.col("strategy"))).alias("strategy"), "stop"))

    if not documents:
        return {"seeds": out_seeds}

    queue = s.where("outcome = 'PAGE'").join(per.select("source_id", "begun"), "source_id").where("seed_no < begun").select("source_id", F.array("seed_no").alias("place"), F.posexplode(specs).alias("i", "x"))
    queue = queue.select("source_id", F.concat("place", F.array("i")).alias("place"), F.col("x.link").alias("url"))
    state = per.join(used, "source_id", "left").select("source_id", "max_requests", "max_documents", "max_document_depth", F.coalesce("used", F.lit(0)).alias("used"), F.lit(0).cast("long").alias("probed"), F.lit(False).alias("full"))
    deepest = conf.where("max_documents > 0").agg(F.max("max_document_depth")).first()[0]  # none: no source asks for documents
    docs, seen = None, None
    page = r.select("url", "error", "ok", "format", "ops", "links")
    for depth in range(0, (-1 if deepest is None else deepest) + 1):
        fresh = queue.groupBy("source_id", "url").agg(F.min("place").alias("place"))
        if seen is not None:
            fresh = fresh.join(seen, ["source_id", "url"], "left_anti")
        ranked = numbered(store(fresh), ["source_id"], ["place"], "n", store).join(state, "source_id").where(~F.col("full") & (F.col("max_document_depth") >= depth))
        ok = (F.col("probed") + F.col("n") <= F.col("max_documents")) & (F.col("used") + F.col("n") <= F.col("max_requests"))
        taken = store(ranked.withColumn("taken", ok))
        now = taken.where("taken").select("source_id", "place", "url", F.lit(depth).alias("depth"), (F.col("used") + F.col("n")).alias("request_no"), "max_document_depth").join(page, "url", "left")
        now = store(now.withColumn("error", F.when(~F.coalesce("ok", F.lit(False)), F.coalesce("error", F.lit("NOT_CAPTURED")))))
        docs = now if docs is None else docs.union(now)
        seen = fresh.select("source_id", "url") if seen is None else seen.union(fresh.select("source_id", "url"))
        more = taken.groupBy("source_id").agg(F.count_if("taken").alias("k"), F.bool_or(~F.col("taken")).alias("f"))
        state = store(state.join(more, "source_id", "left").select("source_id", "max_requests", "max_documents", "max_document_depth", (F.col("used") + F.coalesce("k", F.lit(0))).alias("used"), (F.col("probed") + F.coalesce("k", F.lit(0))).alias("probed"), (F.col("full") | F.coalesce("f", F.lit(False))).alias("full")))
        deeper = now.where(F.col("error").isNull() & ~F.col("format").eqNullSafe(F.lit("openapi")) & (F.col("depth") < F.col("max_document_depth")))
        queue = deeper.select("source_id", "place", F.posexplode(specs).alias("i", "x")).select("source_id", F.concat("place", F.array("i")).alias("place"), F.col("x.link").alias("url"))

    spec = U.api_identity(F.lit("GET"), F.col("url"))
    if docs is None:
        docs = s.select("source_id", F.array("seed_no").alias("place"), "url", F.lit(0).alias("depth"), F.lit(0).cast("long").alias("request_no"), "max_document_depth", "error", "ok", "format", "ops", "links").where("false")
    found = docs.where("format = 'openapi' AND error IS NULL").join(per.select("source_id", "max_endpoints"), "source_id")
    event = F.struct("request_no", F.lit(False).alias("seed"), F.lit(-1).cast("long").alias("before"), F.lit(0).alias("max_requests"), "max_endpoints", F.lit(True).alias("limited"), cut(F.coalesce("ops", empty)).alias("refs"), empty.alias("more"), F.array(spec).alias("first"))
    catalogued = found.groupBy("source_id").agg(F.array_sort(F.collect_list(event)).alias("events"))
    start = F.struct(F.col("keys"), F.lit(0).alias("begun"), F.lit(None).cast("string").alias("stop"))
    ended = store(per.join(catalogued, "source_id", "left").withColumn("keys", F.when(F.col("events").isNull(), F.col("keys")).otherwise(_folded(F.col("events"), start)["keys"])).drop("events"))

    of_docs = docs.groupBy("source_id").agg(F.count("*").alias("documents_probed"), F.count_if(F.col("error").isNotNull()).alias("document_errors"), F.count_if(F.col("error").isNull() & (F.col("format") == "openapi")).alias("specs"), F.count_if(F.col("error").isNotNull() & (F.col("error") != "RESPONSE_TOO_LARGE")).alias("d_failed"))
    stopped = F.col("stop").isin("REQUEST_BUDGET", "MAX_RECORDS", "REPEATED_URL", "FETCH_ERROR", "FORMAT_CHANGED", "REPEATED_PAYLOAD", "STAGNANT")
    of_seeds = out_seeds.groupBy("source_id").agg(
        F.sum("pages").alias("api_pages_visited"), F.sum("records").alias("api_records_sampled"), F.count_if(stopped).alias("pagination_stopped"), F.count_if(F.col("outcome") == "OPENAPI").alias("seed_specs"),
        F.count_if(F.col("outcome").isin("FAILED", "INVALID_RESPONSE") | (F.col("stop") == "FETCH_ERROR")).alias("s_failed"), F.count_if(F.col("outcome").isin("TOO_LARGE", "OPENAPI", "DATA", "PAGE")).alias("good"),
        F.max_by(F.when(F.col("outcome") == "INVALID_RESPONSE", F.lit("INVALID_RESPONSE")).otherwise(F.col("error")), F.when(F.col("outcome").isin("FAILED", "INVALID_RESPONSE"), F.col("seed_no"))).alias("last_error"),
    )
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    total = ended.join(used, "source_id", "left").join(of_seeds, "source_id", "left").join(of_docs, "source_id", "left")
    failed = z("s_failed") + z("d_failed")
    success = ~((z("good") == 0) & (failed > 0))
    total = total.select(
        "source_id", (z("used") + z("documents_probed")).alias("requests"), z("api_pages_visited").alias("api_pages_visited"), z("api_records_sampled").alias("api_records_sampled"), z("pagination_stopped").alias("pagination_stopped"),
        z("documents_probed").alias("documents_probed"), z("document_errors").alias("document_errors"), (z("seed_specs") + z("specs")).alias("openapi_documents"), failed.alias("urls_failed"), F.size("keys").alias("api_endpoints"),
        F.coalesce("stop_reason", F.lit("API_SEEDS_EXHAUSTED")).alias("stop_reason"), success.alias("success"), F.when(~success, F.coalesce("last_error", F.lit("API_UNREACHABLE"))).alias("failure_code"),
    )
    requests = done.select("source_id", "request_no", F.when(F.col("step") == 1, "SEED").otherwise("PAGE").alias("phase"), "url", "error").union(docs.select("source_id", "request_no", F.lit("DOCUMENT"), "url", "error"))
    return {"sources": total, "seeds": out_seeds, "attempts": requests, "resources": ended.select("source_id", F.posexplode("keys").alias("place", "identity"))}


def data_endpoint_sources(configs: DataFrame) -> DataFrame:
    """Z13. Sources of a custom data-endpoint configuration (source_id, entrypoint, seeds, data_endpoints) as API sources: the
    endpoints, or else the seeds, are all that is asked, and no documentation is probed; without any they fail as
    CUSTOM_DATA_ENDPOINT_MISSING."""
    clean = F.filter(F.transform(F.coalesce("data_endpoints", F.array().cast(NO_STRINGS)), lambda x: F.trim(x)), lambda x: x != "")
    seeds = F.when(F.size(clean) > 0, clean).otherwise(F.coalesce("seeds", F.array().cast(NO_STRINGS)))
    return configs.select("source_id", seeds.alias("seeds"), F.lit(0).alias("max_documents"), F.when(F.size(seeds) == 0, "CUSTOM_DATA_ENDPOINT_MISSING").alias("failure_code"))
