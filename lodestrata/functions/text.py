"""Text functions as column expressions: folding, slugs, periods, family keys, formats, classification, legacy names."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import urls
from .urls import let

# Fixed values.
MONTHS = {
    1: ["enero", "ene", "january", "jan"],
    2: ["febrero", "feb", "february"],
    3: ["marzo", "mar", "march"],
    4: ["abril", "abr", "april", "apr"],
    5: ["mayo", "may"],
    6: ["junio", "jun", "june"],
    7: ["julio", "jul", "july"],
    8: ["agosto", "ago", "august", "aug"],
    9: ["septiembre", "setiembre", "sep", "sept", "september"],
    10: ["octubre", "oct", "october"],
    11: ["noviembre", "nov", "november"],
    12: ["diciembre", "dic", "december", "dec"],
}
CRAWL_MONTHS = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"]
GENERIC = ["descargar", "download", "ver", "archivo", "documento", "file", "link", "aqui", "pdf", "excel", "xlsx", "xls", "ods", "csv", "json", "xml", "get"]
FORMAT_WORDS = ["pdf", "doc", "docx", "xls", "xlsx", "ods", "csv", "tsv", "json", "xml", "geojson", "zip", "tar", "gz", "tgz", "rar", "7z", "ndjson", "jsonstat", "topojson", "estadistica", "estadisticas", "estadistico", "estadisticos"]
STOP_KEYS = ["reporte", "informe", "boletin", "datos", "data"]
GENERIC_TITLES = ["descargar", "download", "ver", "archivo", "documento", "file", "link", "aqui"]
STRUCTURED = ["csv", "tsv", "xls", "xlsx", "ods", "json", "xml", "geojson", "ndjson", "jsonstat", "topojson"]
DOCUMENTS = ["pdf", "doc", "docx"]
ARCHIVES = ["zip", "tar", "gz", "tgz", "rar", "7z"]
RANKS = {
    "csv": 120, "tsv": 118, "xlsx": 115, "xls": 110, "ods": 108, "json": 106, "ndjson": 105, "geojson": 104, "jsonstat": 103, "topojson": 102,
    "xml": 100, "api": 98, "zip": 80, "tar": 78, "gz": 76, "tgz": 76, "pdf": 50, "docx": 40, "doc": 35, "unknown": 0,
}
POSITIVE = ["estadistic", "dataset", "datos", "serie", "indicador", "boletin estad", "reporte financiero", "informe financiero", "balance", "cartera", "mensual", "trimestral", "semestral", "anuario", "censo", "encuesta", "precios", "produccion", "comercio", "empleo", "presupuesto", "exportacion"]
ADMINISTRATIVE = ["convocatoria", "organigrama", "recursos humanos", "rrhh", "reglamento", "normativa", "resolucion", "formulario", "manual", "contratacion", "licitacion", "mision", "vision", "evento", "publicidad"]
CONTENT_FORMATS = [("text/csv", "csv"), ("text/tab-separated-values", "tsv"), ("application/json", "json"), ("application/geo+json", "geojson"), ("application/xml", "xml"), ("text/xml", "xml"), ("application/pdf", "pdf"), ("spreadsheetml", "xlsx"), ("opendocument.spreadsheet", "ods")]
LEGACY_FORMATS = {"JSONSTAT": "JSON-STAT", "UNKNOWN": "DESCONOCIDO"}

_ALL_MONTHS = sorted((n for names in MONTHS.values() for n in names), key=lambda n: (-len(n), n))
_MONTH = "|".join(_ALL_MONTHS)
_YEAR = r"(?:19|20)\d{2}"
_MM = r"0?[1-9]|1[0-2]"
_DD = r"0?[1-9]|[12]\d|3[01]"
_ACCENTED = "áàâäãåāéèêëēíìîïīóòôöõōúùûüūñçýÿ"
_PLAIN = "aaaaaaaeeeeeiiiiioooooouuuuuncyy"


def fold(text: Column) -> Column:
    """F17. Lower case without accents. Latin letters by a table; texts with anything else beyond ASCII by compatibility
    decomposition in a vectorised function, which gets null for all other rows."""
    quick = fold_latin(text)
    plain = quick.rlike(r"^[\x00-\x7f]*$")
    return F.when(plain, quick).otherwise(_fold_any(F.when(~plain, text)))


def _fold_any(text: Column) -> Column:
    @F.pandas_udf("string")
    def decompose(values: pd.Series) -> pd.Series:
        import unicodedata

        return values.map(lambda v: v and "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)).lower())

    return decompose(text)


def fold_latin(text: Column) -> Column:
    """The table alone: for columns known to hold no other letters; stays within generated code."""
    return F.translate(F.lower(F.coalesce(text, F.lit(""))), _ACCENTED, _PLAIN)


def slugify(text: Column) -> Column:
    """F21."""
    return F.coalesce(F.nullif(F.array_join(F.regexp_extract_all(fold_latin(text), F.lit("([a-z0-9]+)"), 1), "-"), F.lit("")), F.lit("resource"))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def collapse(text: Column) -> Column:
    """F33, one piece: runs of white space become one blank."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def month_number(name: Column) -> Column:
    out = F.lit(None).cast("string")
    for m, names in MONTHS.items():
        out = F.when(name.isin(*names), F.lit(f"{m:02d}")).otherwise(out)
    return out


def _two(x: Column) -> Column:
    return F.lpad(x, 2, "0")


def period_from_text(folded: Column) -> Column:
    """F15. The period of a folded text at the finest precision that the first matching rule gives."""
    return let(folded, _period_rules)


def _period_rules(folded: Column) -> Column:
    g = lambda rx, i: F.regexp_extract(folded, rx, i)
    iso = rf"(?<!\d)({_YEAR})[-_/]({_MM})[-_/]({_DD})(?!\d)"
    dmy = rf"(?<!\d)({_DD})[-_/]({_MM})[-_/]({_YEAR})(?!\d)"
    named = rf"\b({_DD})(?:\s+de)?\s+({_MONTH})(?:\s+de)?\s+({_YEAR})\b"
    quarter = rf"\b[qt]([1-4])\s*[-_/ ]?\s*({_YEAR})\b|\b({_YEAR})\s*[-_/ ]?\s*[qt]([1-4])\b|\b([1-4])(?:er|do|ro|to)?\s+trimestre\s+({_YEAR})\b"
    ym = rf"(?<![a-z0-9])({_YEAR})[-_/ ]({_MM})(?![a-z0-9])"
    my = rf"(?<![a-z0-9])({_MM})[-_/ ]({_YEAR})(?![a-z0-9])"
    year = rf"\b({_YEAR})\b"
    month = F.lit(None).cast("string")
    for name in reversed(_ALL_MONTHS):  # the longest name present wins
        number = next(f"{m:02d}" for m, names in MONTHS.items() if name in names)
        month = F.when(folded.rlike(rf"\b{name}\b"), F.lit(number)).otherwise(month)
    pick = lambda a, b, c: F.when(a != "", a).when(b != "", b).otherwise(c)
    return (
        F.when(folded.rlike(iso), F.concat_ws("-", g(iso, 1), _two(g(iso, 2)), _two(g(iso, 3))))
        .when(folded.rlike(dmy), F.concat_ws("-", g(dmy, 3), _two(g(dmy, 2)), _two(g(dmy, 1))))
        .when(folded.rlike(named), F.concat_ws("-", g(named, 3), month_number(g(named, 2)), _two(g(named, 1))))
        .when(folded.rlike(quarter), F.concat(pick(g(quarter, 2), g(quarter, 3), g(quarter, 6)), F.lit("-Q"), pick(g(quarter, 1), g(quarter, 4), g(quarter, 5))))
        .when(folded.rlike(ym), F.concat_ws("-", g(ym, 1), _two(g(ym, 2))))
        .when(folded.rlike(my), F.concat_ws("-", g(my, 2), _two(g(my, 1))))
        .when(month.isNotNull() & folded.rlike(year), F.concat_ws("-", g(year, 1), month))
        .when(folded.rlike(year), g(year, 1))
    )


def evidence(title: Column, anchor: Column, context: Column, url: Column) -> Column:
    """Z16, unfolded: the parts that are not blank, joined by blanks."""
    some = lambda c: F.nullif(c, F.lit(""))
    return F.concat_ws(" ", some(title), some(anchor), some(context), some(urls.unquote(url)))


def period(label: Column, title: Column, anchor: Column, context: Column, url: Column) -> Column:
    """F16. The given label, else the period of the evidence."""
    return F.when(F.coalesce(label, F.lit("")) != "", blank_to_null(label)).otherwise(period_from_text(fold_latin(evidence(title, anchor, context, url))))


def crawl_period(text: Column) -> Column:
    """F12. Spanish month names, years 20xx; day + month name, month name + year, _MM_YYYY, year."""
    return let(F.lower(text), _crawl_rules)


def _crawl_rules(low: Column) -> Column:
    year = r"\b(20\d{2})\b"
    out = F.when(low.rlike(year), F.regexp_extract(low, year, 1))
    numeric = r"[_\-](0[1-9]|1[0-2])[_\-](20\d{2})\b"
    out = F.when(low.rlike(numeric), F.concat_ws("-", F.regexp_extract(low, numeric, 2), F.regexp_extract(low, numeric, 1))).otherwise(out)
    for k in range(11, -1, -1):
        out = F.when(F.contains(low, F.lit(CRAWL_MONTHS[k])) & low.rlike(year), F.concat(F.regexp_extract(low, year, 1), F.lit(f"-{k + 1:02d}"))).otherwise(out)
    for k in range(11, -1, -1):
        daily = rf"\b({_DD})(?:\s+de)?\s+{CRAWL_MONTHS[k]}(?:\s+de)?\s+(20\d{{2}})\b"
        out = F.when(low.rlike(daily), F.concat(F.regexp_extract(low, daily, 2), F.lit(f"-{k + 1:02d}-"), _two(F.regexp_extract(low, daily, 1)))).otherwise(out)
    return out


def period_precision(p: Column) -> Column:
    """F13. 3 day, 2 month or quarter, 1 year, 0 none."""
    return F.when(p.rlike(r"^\d{4}-\d{2}-\d{2}$"), 3).when(p.rlike(r"^\d{4}-(?:\d{2}|Q[1-4])$"), 2).when(p.rlike(r"^\d{4}$"), 1).otherwise(0)


def best_period(*texts: Column) -> Column:
    """F14. The most precise period of the fields, each judged alone; the first on ties."""
    found = F.transform(F.array(*[F.struct(F.lit(-k).alias("order"), crawl_period(t).alias("value")) for k, t in enumerate(texts)]), lambda x: F.struct(period_precision(x["value"]).alias("precision"), x["order"], x["value"]))
    return let(F.array_max(found), lambda best: F.when(best["precision"] > 0, best["value"]))


def period_sort_key(p: Column) -> Column:
    """W02. (precision, year, part): days above months above quarters above years above none."""
    return let(p, _sort_key)


def _sort_key(p: Column) -> Column:
    year = F.regexp_extract(p, r"^(\d{4})", 1).try_cast("int")
    day = rf"^{_YEAR}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$"
    month, quarter = rf"^{_YEAR}-(0[1-9]|1[0-2])$", rf"^{_YEAR}-Q([1-4])$"
    g = lambda rx, i: F.regexp_extract(p, rx, i).try_cast("int")
    key = lambda a, b, c: F.struct(F.lit(a).alias("precision"), b.alias("year"), c.alias("part"))
    return F.when(p.rlike(day), key(4, year, g(day, 1) * 100 + g(day, 2))).when(p.rlike(month), key(3, year, g(month, 1))).when(p.rlike(quarter), key(2, year, g(quarter, 1))).when(p.rlike(rf"^{_YEAR}$"), key(1, year, F.lit(0))).otherwise(key(0, F.lit(0), F.lit(0)))


def clean_key(text: Column) -> Column:
    """F18. Words of a text without hosts, suffixes, periods, months and generic words, joined by '-'."""
    v = fold_latin(urls.unquote(text))
    for rx in (
        r"https?://[^/\s]+",
        r"\.(?:pdf|docx?|xlsx?|ods|csv|tsv|json|xml|geojson|zip|tar|gz|tgz|rar|7z)\b",
        rf"(?<!\d){_YEAR}[-_/ ](?:{_MM})(?!\d)",
        rf"(?<!\d)(?:{_MM})[-_/ ]{_YEAR}(?!\d)",
        rf"(?<!\d){_YEAR}(?!\d)",
        r"\b[qt][1-4]\b",
        r"\b[1-4](?:er|do|ro|to)?\s+trimestre\b",
        rf"\b(?:{_DD})[-_/](?:{_MM})[-_/]{_YEAR}\b",
        rf"\b(?:{_MONTH})\b",
    ):
        v = F.regexp_replace(v, rx, " ")
    words = F.regexp_extract_all(v, F.lit("([a-z0-9]+)"), 1)
    return F.array_join(F.filter(words, lambda w: ~w.isin(*sorted({*GENERIC, *FORMAT_WORDS}))), "-")


def family_key(title: Column, context: Column, anchor: Column, url: Column, api_identity: Column | None = None) -> Column:
    """F19. The first specific candidate of at least four letters, else the first, else the path."""
    specific = lambda c: let(F.trim(c), lambda t: F.when((t != "") & ~fold_latin(t).isin(*GENERIC), clean_key(t)))
    good = lambda k: (F.length(k) >= 4) & ~k.isin(*STOP_KEYS)

    def others(*first: Column) -> Column:
        base = urls.unquote(F.regexp_extract(F.regexp_replace(urls.path(url), r"/+$", ""), r"([^/]*)$", 1))
        keys = F.filter(F.array(*first, clean_key(blank_to_null(context)), specific(anchor), clean_key(base)), lambda k: k.isNotNull() & (k != ""))
        rest = clean_key(F.regexp_replace(urls.path(url), r"^/+|/+$", ""))
        chosen = let(keys, lambda ks: F.coalesce(F.try_element_at(F.filter(ks, good), F.lit(1)), F.try_element_at(ks, F.lit(1))))
        return F.coalesce(chosen, F.nullif(rest, F.lit("")), F.lit("resource"))

    # the first candidate decides alone for most rows: the others are made only where it does not
    if api_identity is None:
        return let(specific(title), lambda k: F.when(good(k), k).otherwise(others(k)))
    return let(clean_key(api_identity), lambda k: F.when(good(k), k).otherwise(others(k, specific(title))))


def family_id(source_id: Column, key: Column) -> Column:
    """F25."""
    return F.substring(F.sha2(F.concat_ws("|", source_id, key), 256), 1, 24)


def family_title(key: Column) -> Column:
    """F24."""
    return F.array_join(F.transform(F.filter(F.split(key, "-"), lambda w: w != ""), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1000)))), " ")


def format_of(resource_type: Column, api_format: Column, ext: Column, content_type: Column) -> Column:
    """F26."""
    suffix = F.nullif(F.regexp_replace(F.lower(F.trim(ext)), r"^\.+", ""), F.lit(""))

    def by_type(kind: Column) -> Column:
        out = F.lit("unknown")
        for marker, value in reversed(CONTENT_FORMATS):
            out = F.when(F.contains(kind, F.lit(marker)), F.lit(value)).otherwise(out)
        return out

    api = F.coalesce(F.nullif(F.replace(F.lower(F.trim(api_format)), F.lit("-")), F.lit("")), F.lit("api"))
    return F.when(resource_type == "api", api).otherwise(F.coalesce(suffix, let(F.lower(content_type), by_type)))


def classify(resource_type: Column, fmt: Column, folded: Column, has_period: Column, method: Column, api: Column) -> Column:
    """F27. (selected, priority, reason). ``api``: struct of is_openapi, method, auth_required, callable_by_policy, or null."""
    any_of = lambda terms: folded.rlike("|".join(re.escape(t) for t in terms))
    seen = F.struct(any_of(POSITIVE).alias("positive"), any_of(ADMINISTRATIVE).alias("admin"), fmt.alias("fmt"), has_period.alias("dated"), api.alias("api"))
    return let(seen, lambda s: _decide(resource_type, s["fmt"], s["positive"], s["admin"], s["dated"], method, s["api"]))


def _decide(resource_type: Column, fmt: Column, positive: Column, admin: Column, has_period: Column, method: Column, api: Column) -> Column:
    out = lambda ok, priority, reason: F.struct(F.lit(ok).alias("selected"), F.lit(priority).alias("priority"), F.lit(reason).alias("reason"))
    is_api, is_archive, is_doc = resource_type == "api", fmt.isin(*ARCHIVES), fmt.isin(*DOCUMENTS)
    return (
        F.when(is_api & api.isNull(), out(False, "LOW", "api_without_metadata"))
        .when(is_api & api["is_openapi"] & (F.coalesce(method, F.lit("")) != "openapi_get_operation"), out(False, "LOW", "api_documentation_not_dataset"))
        .when(is_api & (F.upper(api["method"]) != "GET"), out(False, "LOW", "api_non_get"))
        .when(is_api & (api["auth_required"] | ~api["callable_by_policy"]), out(False, "LOW", "api_not_publicly_callable"))
        .when(is_api, out(True, "HIGH", "public_get_api"))
        .when(fmt.isin(*STRUCTURED), out(True, "HIGH", "structured_data_format"))
        .when(is_archive & (positive | has_period), out(True, "MEDIUM", "archive_with_statistical_evidence"))
        .when(is_archive, out(False, "LOW", "archive_contents_unknown"))
        .when(is_doc & admin & ~positive, out(False, "LOW", "administrative_document"))
        .when(is_doc & positive & has_period, out(True, "MEDIUM", "periodic_statistical_document"))
        .when(is_doc & positive, out(True, "MEDIUM", "statistical_document"))
        .when(is_doc & has_period, out(True, "MEDIUM", "periodic_document"))
        .when(is_doc, out(False, "LOW", "document_without_data_evidence"))
        .otherwise(out(False, "LOW", "unsupported_or_unknown_format"))
    )


def format_rank(fmt: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for pair in RANKS.items() for x in pair])
    return F.coalesce(F.try_element_at(ranks, fmt), F.lit(0))


def legacy_segment(text: Column) -> Column:
    """F28. ASCII letters and digits, case kept, joined by '_'."""
    plain = F.translate(F.coalesce(text, F.lit("")), _ACCENTED + _ACCENTED.upper(), _PLAIN + _PLAIN.upper())
    return F.coalesce(F.nullif(F.array_join(F.regexp_extract_all(plain, F.lit("([A-Za-z0-9]+)"), 1), "_"), F.lit("")), F.lit("SIN_NOMBRE"))


def legacy_year(p: Column, fallback: str = "SIN_PERIODO") -> Column:
    """F29."""
    return F.coalesce(F.nullif(F.regexp_extract(p, rf"^({_YEAR})", 1), F.lit("")), F.lit(fallback))


def legacy_format(fmt: Column) -> Column:
    """F30."""
    names = F.create_map(*[F.lit(x) for pair in LEGACY_FORMATS.items() for x in pair])
    return let(F.upper(F.trim(F.coalesce(F.nullif(fmt, F.lit("")), F.lit("unknown")))), lambda up: F.coalesce(F.try_element_at(names, up), up))


def legacy_description(title: Column, description: Column, url: Column) -> Column:
    """F31."""
    good = let(F.trim(F.coalesce(title, F.lit(""))), lambda t: F.when((t != "") & ~fold_latin(t).isin(*GENERIC_TITLES), t))
    name = urls.unquote(F.regexp_extract(F.regexp_replace(urls.path(url), r"/+$", ""), r"([^/]*)$", 1))
    return F.coalesce(good, blank_to_null(description), F.nullif(name, F.lit("")), url)


def render(template: Column, captures: Column) -> Column:
    """F22. {name} placeholders from a map; a name without a capture is an error."""
    return let(F.struct(template.alias("t"), captures.alias("c")), lambda s: _render(s["t"], s["c"]))


def _render(template: Column, captures: Column) -> Column:
    names = F.regexp_extract_all(template, F.lit(r"\{(\w+)\}"), 1)
    missing = F.filter(names, lambda n: ~F.map_contains_key(captures, n))
    filled = F.aggregate(F.map_entries(captures), template, lambda acc, e: F.replace(acc, F.concat(F.lit("{"), e["key"], F.lit("}")), e["value"]))
    return F.when(F.size(missing) == 0, filled).otherwise(F.raise_error(F.concat(F.lit("missing capture: "), F.array_join(missing, ", "))))


def error_excerpts(text: Column, tokens: str, limit: int = 5) -> Column:
    """F36. Distinct stretches of text around the tokens (a regular expression), at most ``limit``."""
    rx = F.lit(rf"(?is)(?:{tokens})")
    return F.when(text.isNotNull(), F.slice(F.array_distinct(F.transform(F.coalesce(_excerpts(F.when(F.regexp(text, rx), text), tokens), F.array().cast("array<string>")), collapse)), 1, limit))


def _excerpts(text: Column, tokens: str) -> Column:
    """All matches of ``.{0,160}(?:tokens).{0,240}``, each tried only where one can begin: a search from every character would read 160
    characters for each."""

    @F.pandas_udf("array<string>")
    def cut(values: pd.Series) -> pd.Series:
        token, around = (re.compile(rx, re.A | re.I | re.S) for rx in (rf"(?:{tokens})", rf".{{0,160}}(?:{tokens}).{{0,240}}"))

        def one(v: str) -> list[str]:
            out, at = [], 0
            while m := token.search(v, at):
                found = around.match(v, max(at, m.start() - 160))
                out.append(found.group())
                if found.end() == at:
                    break
                at = found.end()
            return out

        return values.map(lambda v: None if v is None else one(v))

    return cut(text)


def plain_log(text: Column) -> Column:
    """F35. Without ANSI colours, carriage returns and NULs."""
    return F.regexp_replace(F.regexp_replace(text, r"\x1b\[[0-9;]*[A-Za-z]", ""), r"[\r\x00]", "")


def workflow_name(name: Column, aliases: dict[str, str] | None = None) -> Column:
    """F34. Lower-case letters and digits only, then aliases."""
    key = F.regexp_replace(F.lower(name), r"[^a-z0-9]", "")
    out = key
    for a, b in (aliases or {}).items():
        out = F.when(key == a, F.lit(b)).otherwise(out)
    return out


def human_duration(seconds: Column) -> Column:
    """D03. 'h h m min s s', rounded half to even."""
    s = F.bround(seconds).cast("long")
    h, m = F.floor(s / 3600), F.floor((s % 3600) / 60)
    return F.when(h > 0, F.format_string("%d h %d min %d s", h, m, s % 60)).when(m > 0, F.format_string("%d min %d s", m, s % 60)).otherwise(F.format_string("%d s", s % 60))
