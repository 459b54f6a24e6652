"""Audit operators: overlays, tiered matching, decision tables, log segments, timing, histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlay(base: DataFrame, patch: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """J03, J09. ``base`` with the patch's non-null columns laid over it; a key twice in the patch is an error of data
    and multiplies rows, so check it with ``unique_key`` first."""
    p = patch.select(key, *[F.col(c).alias(f"__p_{c}") for c in columns])
    out = base.join(p, key, "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(f"__p_{c}", c) if c in base.columns else F.col(f"__p_{c}"))
    return out.drop(*[f"__p_{c}" for c in columns])


def _keys(df: DataFrame, i: str, c: str) -> DataFrame:
    """(__id, __k): a row's distinct keys, from an array or a scalar column; null keys match nothing."""
    many = F.array_distinct(F.col(c)) if df.schema[c].dataType.typeName() == "array" else F.array(c)
    return df.select(F.col(i).alias("__id"), F.explode(many).alias("__k")).where("__k is not null")


def tiered_match(left: DataFrame, right: DataFrame, left_id: str, right_id: str, tiers: list[tuple[str, str, str | None]]) -> DataFrame:
    """J06. Match by the first tier in which a row has any partner. A tier names the columns to compare (arrays or scalars),
    and a column of the left by which several partners are narrowed to one. Returns left_id, right_id, tier, outcome: OK,
    AMBIGUOUS (several partners, none or several after narrowing) or MISSING.

    The right side is reduced to the smallest and largest id of each key before it is joined: a row has one partner if
    these agree over all its keys, so a key that many rows share expands no pairs."""
    found = None
    for k, (a, b, narrow) in enumerate(tiers, 1):
        held = _keys(right, right_id, b).groupBy("__k").agg(F.min("__id").alias("__lo"), F.max("__id").alias("__hi"))
        reach = lambda c: _keys(left, left_id, c).join(held, "__k").groupBy("__id").agg(F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"))  # noqa: B023, E731
        hits = reach(a).select("__id", F.lit(k).alias("__t"), F.when(F.col("__lo") == F.col("__hi"), F.col("__lo")).alias("__r"))
        if narrow:
            exact = reach(narrow).where("__lo = __hi").select("__id", F.col("__lo").alias("__x"))
            hits = hits.join(exact, "__id", "left").select("__id", "__t", F.coalesce("__r", "__x").alias("__r"))
        found = hits if found is None else found.union(hits)
    best = found.groupBy("__id").agg(F.min_by(F.struct("__t", "__r"), "__t").alias("m"))
    out = left.select(left_id).join(best, F.col(left_id) == F.col("__id"), "left")
    outcome = F.when(F.col("m").isNull(), "MISSING").when(F.col("m.__r").isNull(), "AMBIGUOUS").otherwise("OK")
    return out.select(left_id, F.col("m.__r").alias(right_id), F.col("m.__t").alias("tier"), outcome.alias("outcome"))


SHARE = 1_000_000  # pairs of one key that a task expands


def overlap_matches(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_keys: str, right_keys: str) -> DataFrame:
    """J07. All pairs that share a key, with the sorted keys that they share; as many rows as there are pairs.

    Both rows' keys travel with each of their keys: a pair is told by the least key that it shares, with all of them, so pairs are
    neither stored nor shuffled. A key of more than SHARE pairs is dealt in blocks of the left rows, with the right rows repeated
    for each block, and tasks are as many as the pairs ask for."""

    def side(df: DataFrame, i: str, c: str, name: str, all_: str) -> DataFrame:
        kept = _keys(df, i, c).groupBy("__id").agg(F.collect_set("__k").alias(all_))
        return kept.select(F.col("__id").alias(name), all_, F.explode(all_).alias("__k"))

    a, b = side(left, left_id, left_keys, left_id, "__a"), side(right, right_id, right_keys, right_id, "__b")
    sizes = a.groupBy("__k").agg(F.count("*").alias("__n")).join(b.groupBy("__k").agg(F.count("*").alias("__m")), "__k")
    tasks = (sizes.agg(F.sum(F.col("__n") * F.col("__m"))).first()[0] or 0) // SHARE + 1
    sizes = sizes.select("__k", F.least(F.col("__n"), F.expr(f"1 + __n * __m div {SHARE}")).cast("int").alias("__blocks"))
    a = a.join(sizes, "__k").withColumn("__block", F.pmod(F.xxhash64(left_id), F.col("__blocks")).cast("int")).drop("__blocks")
    b = b.join(sizes, "__k").select(right_id, "__b", "__k", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)).alias("__block"))
    a, b = (x.repartition(tasks, "__k", "__block") for x in (a, b))
    shared = a.join(b.hint("shuffle_hash"), ["__k", "__block"]).withColumn("overlap", F.sort_array(F.array_intersect("__a", "__b")))
    return shared.where(F.get("overlap", F.lit(0)) == F.col("__k")).select(left_id, right_id, "overlap")


def decision_table(conditions: list[tuple[Column, dict[str, object]]], default: dict[str, object]) -> Column:
    """C01-C24. An ordered decision table as one expression: a struct of the first row whose condition holds."""
    row = lambda d: F.struct(*[F.lit(v).alias(k) for k, v in d.items()])
    out = row(default)
    for cond, values in reversed(conditions):
        out = F.when(cond, row(values)).otherwise(out)
    return out


def log_segments(lines: DataFrame, log: str, order: str, is_header: Column) -> DataFrame:
    """W09. Each line's segment: the number of headers up to it; lines before the first have segment 0."""
    return lines.withColumn("segment", F.sum(F.coalesce(is_header.cast("int"), F.lit(0))).over(Window.partitionBy(log).orderBy(order)))


def last_match(text: Column, pattern: str) -> Column:
    """W10. The last capture of a pattern; null without one."""
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), 1), F.lit(-1))


def timing(runs: DataFrame, key: str, start: str, finish: str) -> DataFrame:
    """A18, D04, W14. Active time, wall time and gap of each key, in seconds, never negative."""
    active = F.greatest(F.lit(0.0), (F.unix_micros(finish) - F.unix_micros(start)) / 1e6)
    out = runs.groupBy(key).agg(F.count("*").alias("runs"), F.sum(active).alias("active_s"), F.min(start).alias("first_start"), F.max(finish).alias("last_finish"))
    wall = F.greatest(F.lit(0.0), (F.unix_micros("last_finish") - F.unix_micros("first_start")) / 1e6)
    return out.withColumn("wall_s", wall).withColumn("gap_s", F.greatest(F.lit(0.0), F.col("wall_s") - F.col("active_s")))


def histogram(df: DataFrame, column: str) -> DataFrame:
    """A11, A19, T05. Counts by value, UNKNOWN for null."""
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("UNKNOWN")).alias(column)).agg(F.count("*").alias("n"))


def multi_histogram(df: DataFrame, columns: list[str]) -> DataFrame:
    """A12, A20. Counts along each of several columns in one pass of grouping sets: axis, value, n."""
    sets = df.groupingSets([[F.col(c)] for c in columns], *columns).agg(F.count("*").alias("n"), *[F.grouping(c).alias(f"__g_{c}") for c in columns])
    axis, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for c in reversed(columns):
        axis, value = F.when(F.col(f"__g_{c}") == 0, F.lit(c)).otherwise(axis), F.when(F.col(f"__g_{c}") == 0, F.col(c).cast("string")).otherwise(value)
    return sets.select(axis.alias("axis"), F.coalesce(value, F.lit("UNKNOWN")).alias("value"), "n")


def precedence(parts: list[DataFrame], key: str) -> DataFrame:
    """J13. Of the rows of each key, the one from the earliest table in the list; tables unique on the key."""
    every = None
    for k, p in enumerate(parts):
        q = p.withColumn("tier", F.lit(k))
        every = q if every is None else every.unionByName(q)
    return every.groupBy(key).agg(F.min_by(F.struct(*every.columns), "tier").alias("__r")).select("__r.*")


def checks(row: DataFrame, named: dict[str, Column]) -> DataFrame:
    """A31, A33, A34, Z47, Z51. Named conditions as rows (name, ok)."""
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.coalesce(c, F.lit(False)).alias("ok")) for n, c in named.items()])).alias("c")).select("c.*")


def evidence_by_url(df: DataFrame) -> DataFrame:
    """A13. Of each URL: sorted distinct titles, methods and types, and whether any row is an API."""
    names = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    return df.groupBy("url").agg(names("title").alias("titles"), names("discovery_method").alias("methods"), names("resource_type").alias("types"), F.bool_or(F.col("resource_type") == "api").alias("is_api"))


def workflow_compatibility(logical: Column, physical: Column, specializations: dict[str, list[str]]) -> Column:
    """J15."""
    special = F.lit(False)
    for general, special_ones in specializations.items():
        special = special | ((logical == general) & physical.isin(*special_ones))
    return F.when(logical == physical, "EXACT").when(special, "COMPATIBLE_SPECIALIZATION").otherwise("INCOMPATIBLE")


def status_split(trace: DataFrame, by: list[str], url: str, code: str) -> DataFrame:
    """Z38. Sorted distinct status codes, of robots.txt and of the site apart."""
    robots = F.lower(F.col(url)).endswith("/robots.txt")
    codes = lambda cond: F.array_join(F.sort_array(F.collect_set(F.when(cond, F.col(code)))), ",")
    return trace.groupBy(*by).agg(codes(robots).alias("robots_codes"), codes(~robots).alias("site_codes"))


def first_n(df: DataFrame, by: list[str], order: list, n: int) -> DataFrame:
    """T03. The first ``n`` rows of each key. Spark keeps ``n`` rows of a key in each task before it deals them out, so a large key
    costs no more than tasks times ``n`` rows."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__rank") <= n).drop("__rank")


def signal_counts(rows: DataFrame, signals: str) -> DataFrame:
    """A22. (signal, n) over an array column; null arrays and null signals do not count."""
    return rows.select(F.explode(signals).alias("signal")).where("signal IS NOT NULL").groupBy("signal").agg(F.count("*").alias("n"))


def unique_rows(df: DataFrame, key: str) -> DataFrame:
    """J22. The table, one row for each key; reading it fails on a key that occurs twice."""
    n, rest = F.count("*"), [c for c in df.columns if c != key]
    one = df.groupBy(key).agg(F.first(F.struct(*rest)).alias("__r"), F.assert_true(n == 1, F.concat(F.lit(f"repeated {key}: "), F.col(key).cast("string"))).alias("__ok"))
    return one.where("__ok IS NULL").select(key, "__r.*")
