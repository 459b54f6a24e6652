"""Projection of the catalog: decisions, representations, families, ranks, grouping contracts, legacy slots."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

NO_API = "struct<is_openapi:boolean,method:string,auth_required:boolean,callable_by_policy:boolean,format:string,identity:string>"


def decide(resources: DataFrame) -> DataFrame:
    """F16, F19, F25, F26, F27 over resources: format, period, family and the decision for each. Expects title, url,
    resource_type, file_extension; anchor_text, context_text, period_label, content_type, api, discovery_method may lack."""
    have = resources.columns
    c = lambda name, kind="string": F.col(name) if name in have else F.lit(None).cast(kind)
    api = c("api", NO_API)
    out = resources.withColumn("format", T.format_of(F.col("resource_type"), api["format"], F.col("file_extension"), c("content_type")))
    out = out.withColumn("period", T.period(c("period_label"), F.col("title"), c("anchor_text"), c("context_text"), F.col("url")))
    folded = T.fold_latin(T.evidence(F.col("title"), c("anchor_text"), c("context_text"), F.col("url")))
    out = out.withColumn("__d", T.classify(F.col("resource_type"), F.col("format"), folded, F.col("period").isNotNull(), c("discovery_method"), api))
    out = out.select("*", "__d.*").drop("__d")
    identity = api["identity"] if "api" in have else None
    out = out.withColumn("family_key", T.family_key(F.col("title"), c("context_text"), c("anchor_text"), F.col("url"), identity))
    return out.withColumn("family_id", T.family_id(F.col("source_id"), F.col("family_key")))


def rank(resource_type: Column, fmt: Column) -> Column:
    """An API competes as one at least."""
    return F.when(resource_type == "api", F.greatest(T.format_rank(fmt), F.lit(T.RANKS["api"]))).otherwise(T.format_rank(fmt))


def preferred(decisions: DataFrame) -> DataFrame:
    """W01, A06. Of each source, family and period the selected representation of the highest rank, least key on ties: an
    aggregation, so a family that holds a third of all rows is reduced before it is shuffled."""
    best = F.min_by(F.struct(*decisions.columns), F.struct(-rank(F.col("resource_type"), F.col("format")), F.col("resource_key")))
    return decisions.where("selected").groupBy("source_id", "family_key", "period").agg(best.alias("__r")).select("__r.*")


def families(decisions: DataFrame) -> DataFrame:
    """A06, A07, W02. Of each family: periods, representations, formats best first, latest period."""
    d = decisions.where("selected")
    key = T.period_sort_key(F.col("period"))
    formats = F.array_join(F.transform(F.array_sort(F.collect_set(F.struct((-T.format_rank(F.col("format"))).alias("r"), F.col("format").alias("f")))), lambda x: x["f"]), ",")
    return d.groupBy("source_id", "family_key").agg(
        F.count("*").alias("representations"), F.countDistinct("period").alias("periods"), formats.alias("formats"), F.max_by("period", F.struct(key, "period")).alias("latest_period")
    )


def tree(decisions: DataFrame) -> DataFrame:
    """The projection as a nested row per source: families, their periods latest first, their representations best first."""
    d = decisions.where("selected").withColumn("__r", -rank(F.col("resource_type"), F.col("format")))
    reps = F.transform(F.array_sort(F.collect_list(F.struct("__r", "resource_key", "url", "format"))), lambda x: F.struct(x["resource_key"].alias("resource_key"), x["url"].alias("url"), x["format"].alias("format")))
    periods = d.groupBy("source_id", "family_key", "period").agg(reps.alias("representations"))
    key = T.period_sort_key(F.col("period"))
    neg = F.struct((-key["precision"]).alias("a"), (-key["year"]).alias("b"), (-key["part"]).alias("c"), F.col("period"), F.col("representations"))
    fam = periods.groupBy("source_id", "family_key").agg(F.transform(F.array_sort(F.collect_list(neg)), lambda x: F.struct(x["period"].alias("period"), x["representations"].alias("representations"))).alias("periods"))
    return fam.groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("family_key", "periods"))).alias("families"))


@dataclass(frozen=True)
class Rule:
    """F23, E03. An ordered grouping rule: regular expressions by field, and templates over their named captures."""

    rule_id: str
    patterns: dict[str, str]
    family_key: str
    family_title: str | None = None


def java_pattern(pattern: str) -> str:
    return re.sub(r"\(\?P<", "(?<", pattern)


def _capture_map(rule: Rule) -> tuple[Column, Column]:
    """Whether the rule matches, and its captures; a name in several fields must capture the same text."""
    ok, names = F.lit(True), {}
    for field, pattern in rule.patterns.items():
        java = java_pattern(pattern)
        ok = ok & F.coalesce(F.col(field), F.lit("")).rlike(f"(?iu){java}")
        for name, k in re.compile(re.sub(r"\(\?<(?![=!])", "(?P<", java)).groupindex.items():
            names.setdefault(name, []).append(F.regexp_extract(F.coalesce(F.col(field), F.lit("")), f"(?iu){java}", k))
    for values in names.values():
        for v in values[1:]:
            ok = ok & (v == values[0])
    captures = F.create_map(*[x for n, v in names.items() for x in (F.lit(n), v[0])]) if names else F.create_map().cast("map<string,string>")
    return ok, captures


def group_by_contract(resources: DataFrame, rules: list[Rule], unmatched: str = "exclude") -> DataFrame:
    """J16. The first rule that matches gives family key and title. Rules are compiled into one ordered expression, so
    there is no join. ``unmatched``: 'exclude' (excluded = true) or 'fallback' (the generic family key)."""
    rule_id, key, title = F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(rules):
        ok, captures = _capture_map(rule)
        made = T.slugify(T.render(F.lit(rule.family_key), captures))
        name = T.render(F.lit(rule.family_title), captures) if rule.family_title else T.family_title(made)
        rule_id, key, title = F.when(ok, F.lit(rule.rule_id)).otherwise(rule_id), F.when(ok, made).otherwise(key), F.when(ok, name).otherwise(title)
    out = resources.withColumns({"rule_id": rule_id, "contract_key": key, "contract_title": title})
    return out.withColumn("excluded", F.col("rule_id").isNull() & F.lit(unmatched == "exclude"))


def legacy_slots(chosen: DataFrame, route: tuple[str, ...] = ("files", "{family}", "{year}")) -> DataFrame:
    """W03, W04, F28-F32. Route and slot of each representation: newest first within a route, then by rank, URL and key.
    Daily periods sort last, as the legacy document has them."""
    values = F.create_map(
        F.lit("family"), T.legacy_segment(T.family_title(F.col("family_key"))), F.lit("family_key"), T.legacy_segment(F.col("family_key")), F.lit("year"), T.legacy_year(F.col("period")),
        F.lit("period"), T.legacy_segment(F.coalesce("period", F.lit("SIN_PERIODO"))), F.lit("source_id"), T.legacy_segment(F.col("source_id")), F.lit("format"), T.legacy_segment(T.legacy_format(F.col("format"))),
    )
    out = chosen.withColumn("__v", values).withColumn("route", F.concat_ws("/", *[T.render(F.lit(s), F.col("__v")) for s in route])).drop("__v")
    p = T.period_sort_key(F.col("period"))
    dated = p["precision"].isin(1, 2, 3)
    order = [F.when(dated, p["precision"]).otherwise(0).desc(), F.when(dated, p["year"]).otherwise(0).desc(), F.when(dated, p["part"]).otherwise(0).desc(), rank(F.col("resource_type"), F.col("format")).desc(), F.col("url"), F.col("resource_key")]
    n = F.row_number().over(Window.partitionBy("source_id", "route").orderBy(*order))
    return out.withColumn("slot", F.when(n == 1, "Descargar.csv").otherwise(F.concat(F.lit("Descargar_"), n.cast("string"), F.lit(".csv"))))


def legacy_records(slots: DataFrame) -> DataFrame:
    """P05. The six fields of the legacy document, all strings."""
    c = lambda name: F.col(name) if name in slots.columns else F.lit(None).cast("string")
    raw = F.coalesce(T.blank_to_null(c("raw_url")), F.col("url"))
    return slots.select(
        "source_id", "route", "slot",
        T.legacy_description(F.col("title"), c("context_text"), raw).alias("descripcion"),
        F.trim(raw).alias("url_descarga"),
        F.coalesce(F.trim("period"), F.lit("")).alias("fecha_actualizacion"),
        T.legacy_format(F.col("format")).alias("tipo_archivo"),
        F.coalesce(F.trim(c("discovered_from_url")), F.lit("")).alias("url_origen"),
        F.coalesce(F.trim(c("discovery_method")), F.lit("")).alias("metodo_deteccion"),
    )


def validate_legacy(records: DataFrame) -> DataFrame:
    """A24, A25. Valid and invalid records of each source: slot name, six fields present, route not empty."""
    fields = ["descripcion", "url_descarga", "fecha_actualizacion", "tipo_archivo", "url_origen", "metodo_deteccion"]
    ok = F.col("slot").rlike(r"^Descargar(?:_(?:[2-9]|[1-9]\d+))?\.csv$") & (F.col("route") != "")
    for f in fields:
        ok = ok & F.col(f).isNotNull()
    return records.groupBy("source_id").agg(F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid"))
