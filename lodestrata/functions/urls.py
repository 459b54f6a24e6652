"""URL functions as column expressions: splitting, joining, normal form, identity, families."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
TRACKING = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid", "msclkid", "sessionid", "phpsessid", "jsessionid"]
PAGINATION_QUERY = ["page", "page_number", "pagenumber", "page_size", "pagesize", "per_page", "perpage", "offset", "limit", "cursor", "continuation", "continuation_token", "skip"]
PAGINATION_FAMILY = ["page", "p", "pg", "pageno", "page_no", "page_num", "pagina", "offset", "start", "from", "skip"]
EXTENSIONS = [".csv", ".tsv", ".xls", ".xlsx", ".ods", ".json", ".xml", ".geojson", ".pdf", ".doc", ".docx", ".zip", ".tar", ".gz", ".tgz", ".rar", ".7z"]

PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
# A URL that is its own normal form: no port, nothing to decode or to encode, one query pair at most and no tracking parameter.
PLAIN = rf"^https?://[a-z0-9.\-]+/[A-Za-z0-9._~/\-]*(?:\?(?!(?i:{'|'.join(TRACKING)})=)[A-Za-z0-9._\-]+=[A-Za-z0-9._\-]*)?\z"


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once: without it each mention would be computed, and compiled, again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, PARTS, group)


def scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def netloc(url: Column) -> Column:
    return F.lower(_part(url, 2))


def host(url: Column) -> Column:
    """Host without user, port and a closing dot, in lower case."""
    return F.regexp_replace(netloc(url), r"^.*@|:\d*$|\.$", "")


def path(url: Column) -> Column:
    return _part(url, 3)


def query(url: Column) -> Column:
    return _part(url, 4)


def canonical_host(url: Column) -> Column:
    return F.regexp_replace(host(url), r"^www\.", "")


def unquote(text: Column) -> Column:
    """Percent decoding that leaves plus signs and malformed escapes as they are."""
    return let(text, lambda t: F.coalesce(F.try_url_decode(F.replace(t, F.lit("+"), F.lit("%2B"))), t))


def _quote(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def pairs(url: Column) -> Column:
    """Decoded query pairs as an array of (k, v); blank values are kept."""
    decode = lambda x: F.coalesce(F.try_url_decode(x), x)
    items = F.filter(F.split(query(url), "&"), lambda p: p != "")
    return F.transform(items, lambda p: F.struct(decode(F.substring_index(p, "=", 1)).alias("k"), decode(F.when(F.contains(p, F.lit("=")), F.regexp_replace(p, r"^[^=]*=", "")).otherwise("")).alias("v")))


def encode_pairs(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda p: F.concat(_quote(p["k"]), F.lit("="), _quote(p["v"]))), "&")


def _among(name: Column, names: list[str]) -> Column:
    return F.lower(name).isin(*names)


def remove_dots(p: Column) -> Column:
    """Path without . and .. segments."""
    last = F.element_at(F.split(p, "/"), -1)
    parts = F.aggregate(
        F.split(p, "/"),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc)).when(s == ".", acc).otherwise(F.concat(acc, F.array(s))),
    )
    joined = F.array_join(parts, "/")
    return F.when(last.isin(".", "..") & ~joined.endswith("/"), F.concat(joined, F.lit("/"))).otherwise(joined)


def join(base: Column, raw: Column) -> Column:
    """Reference resolution after RFC 3986."""
    return let(F.struct(base.alias("base"), F.trim(raw).alias("raw")), lambda s: _join(s["base"], s["raw"]))


def _join(base: Column, raw: Column) -> Column:
    origin = F.concat(scheme(base), F.lit("://"), _part(base, 2))
    folder = F.regexp_replace(path(base), r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    tail = F.regexp_extract(raw, r"(?s)^[^?#]*(.*)$", 1)
    own = path(raw)
    return (
        F.when(_part(raw, 1) != "", raw)
        .when(raw.startswith("//"), F.concat(scheme(base), F.lit(":"), raw))
        .when(raw == "", base)
        .when(raw.startswith("/"), F.concat(origin, remove_dots(own), tail))
        .when(raw.startswith("?"), F.concat(origin, path(base), tail))
        .when(raw.startswith("#"), F.concat(F.regexp_replace(base, r"(?s)#.*$", ""), tail))
        .otherwise(F.concat(origin, remove_dots(F.concat(folder, own)), tail))
    )


def normalize(raw: Column, base: Column | None = None) -> Column:
    """F01. Trimmed and absolute; scheme and host in lower case, default port gone, path at least '/', tracking
    parameters dropped, query sorted and re-encoded, no fragment. Other schemes than http and https are left alone."""
    return let(F.trim(raw) if base is None else join(base, raw), lambda url: F.when(url.rlike(PLAIN), url).otherwise(_normal(url)))


def _normal(url: Column) -> Column:
    return let(F.struct(url.alias("url"), scheme(url).alias("scheme"), netloc(url).alias("netloc"), path(url).alias("path")), _normal_of)


def _normal_of(x: Column) -> Column:
    url, s, n = x["url"], x["scheme"], x["netloc"]
    n = F.when(s == "http", F.regexp_replace(n, r":80$", "")).when(s == "https", F.regexp_replace(n, r":443$", "")).otherwise(n)
    kept = F.array_sort(F.filter(pairs(url), lambda p: ~_among(p["k"], TRACKING)))
    q = F.coalesce(F.concat(F.lit("?"), F.nullif(encode_pairs(kept), F.lit(""))), F.lit(""))
    p = F.when(x["path"] == "", F.lit("/")).otherwise(x["path"])
    return F.when(~s.isin("http", "https") | (x["netloc"] == ""), url).otherwise(F.concat(s, F.lit("://"), n, p, q))


def url_hash(url: Column) -> Column:
    return F.sha2(url, 256)


def resource_key(source_id: Column, url: Column) -> Column:
    return F.sha2(F.concat_ws("|", source_id, url), 256)


def _unpaged(clean: Column) -> Column:
    kept = F.nullif(encode_pairs(F.filter(pairs(clean), lambda p: ~_among(p["k"], PAGINATION_QUERY))), F.lit(""))
    return F.concat(F.substring_index(clean, "?", 1), F.coalesce(F.concat(F.lit("?"), kept), F.lit("")))


def api_identity(method: Column, url: Column) -> Column:
    """F04. ``METHOD url`` in normal form without pagination parameters."""
    return F.concat(F.upper(method), F.lit(" "), let(normalize(url), _unpaged))


def same_identity(a: Column, b: Column) -> Column:
    """Whether two URLs in normal form have one API identity. Those that are equal but for pagination need no second normal form;
    only spaces and odd ports change in one."""
    plain = ~F.contains(a, F.lit(" ")) & ~F.contains(b, F.lit(" "))
    return (plain & (_unpaged(a) == _unpaged(b))) | (api_identity(F.lit("GET"), a) == api_identity(F.lit("GET"), b))


def extension(url: Column) -> Column:
    """F05. The path's suffix if it is a known one, else the longest known one anywhere in the decoded URL (ties by text)."""
    return let(url, lambda u: let(F.struct(F.lower(F.regexp_extract(path(u), r"[^/.][^/]*(\.[^./]*)$", 1)).alias("suffix"), F.lower(unquote(u)).alias("decoded")), lambda s: _extension(s["suffix"], s["decoded"])))


def _extension(suffix: Column, decoded: Column) -> Column:
    found = F.lit("")
    for e in sorted(EXTENSIONS, key=lambda e: (len(e), [-ord(c) for c in e])):
        found = F.when(F.contains(decoded, F.lit(e)), F.lit(e)).otherwise(found)
    return F.when(suffix.isin(*EXTENSIONS), suffix).otherwise(found)


def is_resource(url: Column) -> Column:
    return extension(url) != ""


def pagination_family(url: Column) -> Column:
    """F06. Template with * for page values; null if the URL is not one of a pagination."""
    return let(url, _pagination)


def _pagination(url: Column) -> Column:
    in_path = r"(?i)(/(?:page|pagina|p)/)\d+(?=/|$)"
    p = path(url)
    items = pairs(url)
    paged = F.exists(items, lambda x: _among(x["k"], PAGINATION_FAMILY))
    starred = F.transform(F.array_sort(items), lambda x: F.struct(x["k"].alias("k"), F.when(_among(x["k"], PAGINATION_FAMILY), F.lit("*")).otherwise(x["v"]).alias("v")))
    q = encode_pairs(starred)
    shape = F.concat(scheme(url), F.lit("://"), netloc(url), F.regexp_replace(F.when(p == "", F.lit("/")).otherwise(p), in_path, "$1*"), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))
    web = scheme(url).isin("http", "https") & (netloc(url) != "")
    return F.when(web & (paged | p.rlike(in_path)), shape)


def calendar_family(url: Column) -> Column:
    """F07. (template, value) of a date in the path: /Y/M[/D] or Y-M[-D]; null without one."""
    return let(url, _calendar)


def _calendar(url: Column) -> Column:
    p = path(url)
    date = r"/((?:19|20)\d{2}[/-](?:0?[1-9]|1[0-2])(?:[/-](?:0?[1-9]|[12]\d|3[01]))?)(?=/|$)"
    value = F.regexp_extract(p, date, 1)
    shape = F.concat(scheme(url), F.lit("://"), netloc(url), F.regexp_replace(p, date, "/DATE"))
    return F.when(value != "", F.struct(shape.alias("template"), value.alias("value")))


def query_family(url: Column) -> Column:
    """Host, path and the sorted set of lower-case query names."""
    names = lambda u: F.array_sort(F.array_distinct(F.transform(pairs(u), lambda p: F.lower(p["k"]))))
    return let(url, lambda u: F.concat_ws("|", netloc(u), path(u), F.array_join(names(u), ",")))


def repeated_segments(p: Column) -> Column:
    """F56. At least four equal consecutive path segments."""
    return F.lower(p).rlike(r"(?:^|/)([^/]+)(?:/+\1){3}(?:/|$)")


def same_site(a: Column, b: Column) -> Column:
    """F72. Equal hosts after www., or one a subdomain of the other."""
    x, y = canonical_host(a), canonical_host(b)
    return (x == y) | x.endswith(F.concat(F.lit("."), y)) | y.endswith(F.concat(F.lit("."), x))


def kind_of(ext: Column) -> Column:
    """F10. table, document, archive, data or other."""
    e = F.lower(F.regexp_replace(ext, r"^\.", ""))
    return F.when(e.isin("csv", "tsv", "xls", "xlsx", "ods"), "table").when(e.isin("pdf", "doc", "docx"), "document").when(e.isin("zip", "tar", "gz", "tgz", "rar", "7z"), "archive").when(e.isin("json", "xml", "geojson"), "data").otherwise("other")


def entrypoint(url: Column) -> Column:
    """F09."""
    return F.regexp_replace(url, r"/+$", "")
