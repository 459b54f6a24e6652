"""API functions: format of a body, records, pagination, links, fingerprints, OpenAPI operations."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import urls as U

# Fixed values.
API_PATHS = ["/api/", "/api?", "/rest/", "/wp-json/", "/odata/", "/openapi", "/swagger", "/api-docs", "/geoserver/", "/arcgis/rest/", "/featureserver", "/mapserver", "/graphql"]
OPENAPI_PATHS = ["openapi.json", "openapi.yaml", "openapi.yml", "swagger.json", "swagger.yaml", "swagger.yml", "/api-docs", "/v3/api-docs"]
OGC = ["wfs", "wms", "wcs", "wmts"]
PAGED_KEYS = ["next", "next_page", "nextpage", "page", "pages", "total_pages", "totalpages", "cursor", "offset", "limit", "links", "pagination"]
LIST_KEYS = ["features", "items", "data", "results", "records"]
SHAPE_KEYS = ["data", "results", "items", "records", "features", "observations", "series", "rows", "values"]
NEXT_KEYS = ["next", "next_url", "nexturl", "next_page_url", "nextpageurl"]
NEXT_CONTAINERS = ["links", "pagination", "meta"]
CURRENT_PAGE_KEYS = ["current_page", "currentpage", "page"]
TOTAL_PAGE_KEYS = ["total_pages", "totalpages", "pages", "page_count", "pagecount"]
PAGE_QUERY_KEYS = ["page", "page_number", "pagenumber"]
CURSOR_KEYS = ["next_cursor", "nextcursor", "continuation_token", "continuation"]
CURSOR_QUERY_KEYS = ["cursor", "continuation", "continuation_token"]
CONTENT_EXTENSIONS = {
    "application/pdf": ".pdf", "application/vnd.ms-excel": ".xls", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": ".xlsx", "text/csv": ".csv",
    "application/zip": ".zip", "application/x-zip-compressed": ".zip", "application/json": ".json", "application/xml": ".xml", "text/xml": ".xml",
}


def _has(text: Column, parts: list[str]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(text, F.lit(p))
    return out


def is_openapi_url(url: Column) -> Column:
    """F59."""
    return _has(F.lower(url), OPENAPI_PATHS)


def is_api_url(url: Column) -> Column:
    """F58."""
    return U.let(F.lower(url), lambda low: U.let(F.struct(low.alias("url"), U.path(low).alias("path"), F.concat(F.lit("?"), U.query(low)).alias("query")), _api_parts))


def _api_parts(s: Column) -> Column:
    path = F.when(s["path"] == "", F.lit("/")).otherwise(s["path"])
    service = F.exists(U.pairs(s["url"]), lambda p: (p["k"] == "service") & p["v"].isin(*OGC))
    return is_openapi_url(s["url"]) | U.let(F.concat(path, s["query"]), lambda c: _has(c, API_PATHS)) | service | F.regexp_replace(path, r"/+$", "").rlike(r"/(ows|wfs|wms|wcs|wmts)$")


def unresolved_params(url: Column) -> Column:
    """F61. A GraphQL URL without a query lacks one."""
    lacks = F.lower(U.path(url)).contains("graphql") & ~F.exists(U.pairs(url), lambda p: F.lower(p["k"]) == "query")
    return F.when(lacks, F.array(F.lit("query"))).otherwise(F.array().cast("array<string>"))


def callable_by_policy(method: Column, auth: Column, unresolved: Column) -> Column:
    """F60."""
    return (F.upper(method) == "GET") & ~auth & (F.size(unresolved) == 0)


def is_markup(content_type: Column) -> Column:
    """F63. A missing type counts as markup."""
    c = F.lower(F.trim(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))
    return (c == "") | c.startswith("text/") | c.isin("application/xhtml+xml", "application/xml")


def direct_extension(content_type: Column, url: Column) -> Column:
    """H07."""
    c = F.lower(F.trim(F.substring_index(F.coalesce(content_type, F.lit("")), ";", 1)))
    by_type = F.lit("")
    for kind, ext in CONTENT_EXTENSIONS.items():
        by_type = F.when(c == kind, F.lit(ext)).otherwise(by_type)
    return U.let(U.extension(url), lambda own: F.when(own == "", by_type).otherwise(own))


def declared_format(content_type: Column, url: Column) -> Column:
    """X02."""
    c, openapi = F.lower(F.coalesce(content_type, F.lit(""))), is_openapi_url(url)
    return (
        F.when(c.rlike(r"geo\+json|geojson"), "geojson").when(c.rlike(r"topo\+json|topojson"), "topojson").when(c.rlike("ndjson|json-seq"), "ndjson")
        .when(c.contains("json") & openapi, "openapi").when(c.contains("json"), "json").when(c.contains("xml"), "xml")
        .when(c.rlike("tab-separated-values|text/tsv"), "tsv").when(c.rlike("(text|application)/csv"), "csv").when(c.contains("yaml") & openapi, "openapi")
    )


def _keys(body: Column) -> Column:
    return F.coalesce(F.json_object_keys(body), F.array().cast("array<string>"))


def _is_json(body: Column) -> Column:
    """One JSON value; several lines that are each a value are none."""
    lines = F.filter(F.split(body, r"\r?\n"), lambda x: F.trim(x) != "")
    return F.try_parse_json(body).isNotNull() & ~(F.contains(body, F.lit("\n")) & (F.size(lines) > 1) & F.forall(lines, lambda x: F.try_parse_json(x).isNotNull()))


def _starts(body: Column, path: str, opening: str) -> Column:
    return F.coalesce(F.ltrim(F.get_json_object(body, path)).startswith(opening), F.lit(False))


def detect_format(body: Column, content_type: Column) -> Column:
    """X01. Format of a body, by type and content; null if unknown."""
    given = F.struct(body.alias("body"), F.lower(F.coalesce(content_type, F.lit(""))).alias("type"), F.ltrim(F.coalesce(body, F.lit(""))).alias("text"))

    def with_keys(s: Column) -> Column:
        valid = _is_json(s["body"]) & (s["type"].contains("json") | s["text"].rlike(r"^[{\[]"))
        return U.let(F.struct(s["body"].alias("body"), s["type"].alias("type"), s["text"].alias("text"), valid.alias("valid"), (valid & s["text"].startswith("{")).alias("is_object")), lambda v: U.let(F.struct(v.alias("v"), _keys(F.when(v["is_object"], v["body"])).alias("keys")), lambda x: _format_of(x["v"], x["keys"])))

    return U.let(given, with_keys)


def _format_of(s: Column, keys: Column) -> Column:
    body, c, text, valid, is_object = (s[n] for n in ("body", "type", "text", "valid", "is_object"))
    has = lambda k: F.array_contains(keys, k)
    lines = F.filter(F.split(body, r"\r?\n"), lambda x: F.trim(x) != "")
    ndjson = (F.size(lines) > 0) & F.forall(F.slice(lines, 1, 50), lambda x: F.try_parse_json(x).isNotNull())
    return (
        F.when(c.rlike(r"geo\+json|geojson"), "geojson")
        .when(is_object & (has("openapi") | has("swagger")), "openapi")
        .when(is_object & ((has("type") & (F.get_json_object(body, "$.type") == "FeatureCollection")) | (has("features") & _starts(body, "$.features", "["))), "geojson")
        .when(is_object & has("type") & has("objects") & (F.get_json_object(body, "$.type") == "Topology") & _starts(body, "$.objects", "{"), "topojson")
        .when(is_object & has("class") & has("dimension") & has("value") & (F.lower(F.get_json_object(body, "$.class")) == "dataset") & _starts(body, "$.dimension", "{"), "jsonstat")
        .when(valid, "json")
        .when(c.rlike("ndjson|json-seq"), F.when(ndjson, "ndjson"))
        .when(c.rlike("tab-separated-values|text/tsv"), "tsv")
        .when(c.rlike(r"(application|text)/xml|\+xml") | text.startswith("<?xml") | F.lower(text).rlike("^<(wfs:|ows:|rss|feed)"), "xml")
        .when(c.rlike("(text|application)/csv"), "csv")
        .when(text.rlike(r"^(openapi|swagger):"), "openapi")
    )


def records(body: Column, fmt: Column) -> Column:
    """X03. Number of records by format; null where there is none to count."""
    lines = F.size(F.filter(F.split(body, r"\r?\n"), lambda x: F.trim(x) != "")).cast("long")
    listed = F.lit(None).cast("long")
    for k in reversed(LIST_KEYS):
        listed = F.when(_starts(body, f"$.{k}", "["), F.json_array_length(F.get_json_object(body, f"$.{k}")).cast("long")).otherwise(listed)
    value = F.when(_starts(body, "$.value", "["), F.json_array_length(F.get_json_object(body, "$.value")).cast("long"))
    sizes = F.from_json(F.get_json_object(body, "$.size"), "array<bigint>")
    product = F.when(_starts(body, "$.size", "["), F.aggregate(sizes, F.lit(1).cast("long"), lambda a, x: a * x))
    array = F.ltrim(body).startswith("[")
    ok = _is_json(body)
    return (
        F.when(fmt == "ndjson", lines)
        .when(fmt.isin("csv", "tsv"), F.greatest(F.lit(0).cast("long"), lines - 1))
        .when(~fmt.isin("json", "geojson", "openapi", "jsonstat", "topojson") | ~ok, None)
        .when(array, F.json_array_length(body).cast("long"))
        .when(fmt == "jsonstat", F.coalesce(value, product, listed))
        .when(fmt == "topojson", F.when(_starts(body, "$.objects", "{"), F.size(_keys(F.get_json_object(body, "$.objects"))).cast("long")))
        .otherwise(listed)
    )


def has_pagination(body: Column, url: Column) -> Column:
    """X04."""
    in_query = F.exists(U.pairs(url), lambda p: F.lower(p["k"]).isin(*U.PAGINATION_QUERY))
    is_object = _is_json(body) & F.ltrim(body).startswith("{")
    return in_query | F.exists(_keys(F.when(is_object, body)), lambda k: F.lower(k).isin(*PAGED_KEYS))


def members(body: Column) -> Column:
    """Members (key, value as VARIANT) of a JSON object in its order; null if the body is none."""
    return F.map_entries(F.from_json(body, "map<string,variant>"))


def data_shape(body: Column) -> Column:
    """X15. LIST_RECORDS (two items or more, one of them a list or an object), LIST_SMALL_OR_SCALAR; of objects the first of
    SHAPE_KEYS with a list that is not empty (ARRAY_FIELD:k) or an object of two members or more (OBJECT_FIELD:k), else
    WIDE_OBJECT (8 members or more, 5 of them scalars) or OBJECT_METADATA_OR_SMALL; SCALAR; INVALID if the body is no JSON."""
    nested = lambda v: F.schema_of_variant(v).rlike("^(ARRAY|OBJECT)")
    text = F.ltrim(body)
    items = F.from_json(F.when(text.startswith("["), body), "array<variant>")
    listed = F.when((F.size(items) >= 2) & F.exists(items, nested), "LIST_RECORDS").otherwise("LIST_SMALL_OR_SCALAR")

    def of_object(entries: Column) -> Column:
        def field(k: str) -> Column:
            def named(v: Column) -> Column:
                kind, raw = F.schema_of_variant(v), F.to_json(v)
                return F.when(kind.startswith("ARRAY") & (F.json_array_length(raw) > 0), F.lit(f"ARRAY_FIELD:{k}")).when(kind.startswith("OBJECT") & (F.size(F.json_object_keys(raw)) >= 2), F.lit(f"OBJECT_FIELD:{k}"))

            return F.try_element_at(F.transform(F.filter(entries, lambda e: e["key"] == k), lambda e: named(e["value"])), F.lit(-1))

        wide = (F.size(entries) >= 8) & (F.size(F.filter(entries, lambda e: ~nested(e["value"]))) >= 5)
        return F.coalesce(*[field(k) for k in SHAPE_KEYS], F.when(wide, "WIDE_OBJECT").otherwise("OBJECT_METADATA_OR_SMALL"))

    return F.when(~F.coalesce(_is_json(body), F.lit(False)), "INVALID").when(text.startswith("["), listed).when(text.startswith("{"), U.let(members(body), of_object)).otherwise("SCALAR")


def link_header(value: Column) -> Column:
    """X05. (url, rel) of a Link header's parts."""
    parts = F.regexp_extract_all(value, F.lit(r"(<[^>]*>[^,<]*)"), 1)
    return F.transform(parts, lambda p: F.struct(F.regexp_extract(p, r"<([^>]*)>", 1).alias("url"), F.lower(F.regexp_extract(p, r'(?i)rel\s*=\s*"?([^";]+)"?', 1)).alias("rel")))


def _last(entries: Column, keys: list[str], field: str) -> Column:
    """The field of the first of the keys that has one; of members of one name in lower case the last counts."""

    def of(few: Column) -> Column:
        return F.when(F.size(few) > 0, F.coalesce(*[F.try_element_at(F.filter(few, lambda e: F.lower(e["k"]) == key), F.lit(-1))[field] for key in keys]))  # noqa: B023

    return U.let(F.filter(entries, lambda e: F.lower(e["k"]).isin(*keys)), of)  # most objects have none of them


def _targets(entries: Column) -> Column:
    """Members with what they may hold for a next page: a URL (a string, or an object's url or href), a whole number, a text."""

    def string(v: Column, path: str) -> Column:
        is_string = F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "STRING"
        return F.nullif(F.trim(F.when(is_string, F.try_variant_get(v, path, "string"))), F.lit(""))

    def one(e: Column) -> Column:
        v, kind = e["value"], F.schema_of_variant(e["value"])
        whole = F.when(kind == "BIGINT", F.try_variant_get(v, "$", "bigint"))
        link = F.when(kind == "STRING", string(v, "$")).when(kind.startswith("OBJECT"), F.coalesce(string(v, "$.url"), string(v, "$.href")))
        return F.struct(e["key"].alias("k"), link.alias("url"), whole.alias("n"), F.coalesce(string(v, "$"), whole.cast("string")).alias("text"), F.when(kind.startswith("OBJECT"), F.to_json(v)).alias("object"))

    return F.transform(entries, one)


def next_page(body: Column, link: Column, url: Column) -> Column:
    """X06, X07, X08. (next_url, strategy, reason). The candidate: rel=next of the Link header (http_link_next); the object's
    next (json_next) or that of its links, pagination or meta (json_<container>_next); the page after the current one of a
    known total, where the URL has a page parameter (numeric_page); a cursor, where it has that (cursor). Refused as NO_EXPLICIT_NEXT,
    SAME_PAGE, INVALID_NEXT, NEXT_HOST_CHANGED (ports do not count) or NEXT_IDENTITY_CHANGED, then without a strategy."""
    by_link = F.nullif(F.try_element_at(F.filter(link_header(link), lambda x: x["rel"] == "next"), F.lit(1))["url"], F.lit(""))

    def of(s: Column) -> Column:
        m, pairs = s["m"], s["pairs"]
        nested = {c: U.let(_last(m, [c], "object"), lambda o: F.when(o.isNotNull(), U.let(_targets(members(o)), lambda x: _last(x, NEXT_KEYS, "url")))) for c in NEXT_CONTAINERS}

        def turned(names: list[str], value: Column) -> Column:
            """The URL with the value in the parameter; null without the parameter."""

            def put(x: Column) -> Column:
                changed = F.transform(pairs, lambda p: F.struct(p["k"].alias("k"), F.when(p["k"] == x["own"], x["value"]).otherwise(p["v"]).alias("v")))
                return F.when(x["own"].isNotNull() & x["value"].isNotNull(), F.concat(F.substring_index(url, "?", 1), F.lit("?"), U.encode_pairs(changed)))

            return U.let(F.struct(_last(pairs, names, "k").alias("own"), value.alias("value")), put)

        turn = U.let(F.struct(_last(m, CURRENT_PAGE_KEYS, "n").alias("page"), _last(m, TOTAL_PAGE_KEYS, "n").alias("pages")), lambda x: F.when(x["page"] < x["pages"], (x["page"] + 1).cast("string")))
        found = [("http_link_next", s["link"]), ("json_next", _last(m, NEXT_KEYS, "url")), *[(f"json_{c}_next", v) for c, v in nested.items()]]
        found += [("numeric_page", turned(PAGE_QUERY_KEYS, turn)), ("cursor", turned(CURSOR_QUERY_KEYS, _last(m, CURSOR_KEYS, "text")))]
        return F.coalesce(*[U.let(v, lambda raw: F.when(raw.isNotNull(), F.struct(F.lit(k).alias("strategy"), raw.alias("raw")))) for k, v in found])  # noqa: B023

    names = [*NEXT_KEYS, *NEXT_CONTAINERS, *CURRENT_PAGE_KEYS, *TOTAL_PAGE_KEYS, *CURSOR_KEYS]
    asked = F.filter(members(body), lambda e: F.lower(e["key"]).isin(*names))  # no other member is looked into
    candidate = U.let(F.struct(_targets(asked).alias("m"), U.pairs(url).alias("pairs"), by_link.alias("link")), of)

    def decided(s: Column) -> Column:
        target, current = s["target"], s["current"]
        reason = (
            F.when(target.isNull(), "NO_EXPLICIT_NEXT")
            .when(target == current, "SAME_PAGE")
            .when(~U.scheme(target).isin("http", "https") | (U.host(target) == ""), "INVALID_NEXT")
            .when(U.host(target) != U.host(current), "NEXT_HOST_CHANGED")
            .when(~U.same_identity(target, current), "NEXT_IDENTITY_CHANGED")
            .otherwise("OK")
        )
        return U.let(reason, lambda r: F.struct(F.when(r == "OK", target).alias("next_url"), F.when(r == "OK", s["strategy"]).alias("strategy"), r.alias("reason")))

    return U.let(U.let(candidate, lambda c: F.struct(F.when(c["raw"].isNotNull(), U.normalize(c["raw"], url)).alias("target"), F.when(c["raw"].isNotNull(), U.normalize(url)).alias("current"), c["strategy"].alias("strategy"))), decided)


def canonical_body(body: Column, fmt: Column) -> Column:
    """X09. Text of a body that equal contents share: sorted keys for JSON, whole lines for NDJSON, plain line ends else."""
    @F.pandas_udf("string")
    def canon(bodies: pd.Series, formats: pd.Series) -> pd.Series:
        def dump(x: str) -> str:
            return json.dumps(json.loads(x), sort_keys=True, separators=(",", ":"), ensure_ascii=False)

        def one(b, f):
            if b is None:
                return None
            text = b.lstrip("﻿").replace("\r\n", "\n").replace("\r", "\n")
            try:
                if f in ("json", "geojson", "openapi", "jsonstat", "topojson"):
                    return dump(text)
                if f == "ndjson":
                    return "\n".join(dump(x.strip()) for x in text.split("\n") if x.strip())
            except ValueError:
                pass
            return text

        return pd.Series([one(b, f) for b, f in zip(bodies, formats, strict=True)])

    return canon(body, fmt)


def page_hash(body: Column, fmt: Column) -> Column:
    return F.sha2(canonical_body(body, fmt), 256)


def sample_hash(pages: DataFrame, by: list[str], order: str, digest: str, fmt: str) -> DataFrame:
    """A08. One hash of a chain of page hashes in order."""
    hashes = F.transform(F.array_sort(F.collect_list(F.struct(order, digest))), lambda x: x[digest])
    joined = F.array_join(F.transform(hashes, lambda h, i: F.concat((i + 1).cast("string"), F.lit(":"), h)), "|")
    return pages.groupBy(*by).agg(F.sha2(F.concat_ws("|", F.lit("api-sample-v1"), F.first(fmt), F.count("*").cast("string"), joined), 256).alias("sample_hash"))


def openapi_operations(docs: DataFrame, url: str = "url", body: str = "body") -> DataFrame:
    """X10-X14, Z14. GET operations of OpenAPI 3 and Swagger 2 documents in JSON, by a vectorised table function: the
    resolved server, required parameters without default or example, whether every security choice needs credentials,
    and the response's format. Bodies that are no such document give no rows."""

    def parse(frames):
        for f in frames:
            rows = []
            for u, b in zip(f[url], f[body], strict=True):
                try:
                    doc = json.loads(b)
                except (TypeError, ValueError):
                    continue
                if isinstance(doc, dict) and isinstance(doc.get("paths"), dict) and ("openapi" in doc or "swagger" in doc):
                    base = server_base(doc, u)
                    for ord_, (path, item) in enumerate(doc["paths"].items()):
                        op = item.get("get") if isinstance(item, dict) else None
                        if isinstance(op, dict):
                            rows.append((u, ord_, path, op.get("operationId"), base.rstrip("/") + path, operation_format(doc, op), needs_auth(doc, op), unresolved_of(path, item, op)))
            yield pd.DataFrame(rows, columns=[url, "ord", "path", "operation_id", "url_of_operation", "format", "auth_required", "unresolved"])

    return docs.select(url, body).mapInPandas(parse, f"{url} string, ord int, path string, operation_id string, url_of_operation string, format string, auth_required boolean, unresolved array<string>")


def server_base(doc: dict, url: str) -> str:
    """X11."""
    from urllib.parse import urljoin, urlsplit

    if "swagger" in doc:
        at = urlsplit(url)
        scheme = (doc.get("schemes") or [at.scheme])[0]
        return f"{scheme}://{doc.get('host') or at.netloc}{doc.get('basePath') or ''}"
    servers = doc.get("servers") or [{"url": "/"}]
    base = str(servers[0].get("url") or "/")
    for name, v in (servers[0].get("variables") or {}).items():
        base = base.replace("{" + name + "}", str((v or {}).get("default", "")))
    return urljoin(url, base)


def unresolved_of(path: str, item: dict, op: dict) -> list[str]:
    """X12."""
    import re

    params = [p for p in [*(item.get("parameters") or []), *(op.get("parameters") or [])] if isinstance(p, dict)]
    known = {p.get("name") for p in params if any(k in s for s in (p, p.get("schema") or {}) for k in ("default", "example"))}
    needed = {p["name"] for p in params if p.get("name") and (p.get("required") or p.get("in") == "path")} | set(re.findall(r"\{(\w+)\}", path))
    return sorted(needed - known)


def needs_auth(doc: dict, op: dict) -> bool:
    """X13. An empty requirement among the choices allows anonymous use."""
    choices = op.get("security", doc.get("security"))
    return bool(choices) and all(bool(c) for c in choices)


def operation_format(doc: dict, op: dict) -> str:
    """X14."""
    ok = next((r for code, r in sorted((op.get("responses") or {}).items()) if str(code).startswith("2")), {}) or {}
    kinds = " ".join([*(ok.get("content") or {}), *(op.get("produces") or doc.get("produces") or [])]).lower()
    for mark, fmt in (("geo+json", "geojson"), ("ndjson", "ndjson"), ("json", "json"), ("csv", "csv"), ("xml", "xml")):
        if mark in kinds:
            return fmt
    return "json"


def merge_api(rows: DataFrame, key: str, order: str) -> DataFrame:
    """A09, A10. One row for each identity: flags by OR, first known values in order, callable only if all are."""
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order)))
    return rows.groupBy(key).agg(
        F.bool_or("is_openapi").alias("is_openapi"), F.bool_or("has_pagination").alias("has_pagination"), F.bool_and("callable_by_policy").alias("callable_by_policy"),
        first("format").alias("format"), first("documentation_url").alias("documentation_url"), F.min_by("url", F.struct(~F.col("is_openapi"), F.col("format").isNull(), F.col(order))).alias("url"),
    )


def digest(data: bytes) -> str:
    """D07."""
    return hashlib.sha256(data).hexdigest()
