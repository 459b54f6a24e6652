"""Segmented scans: running aggregates along each key's order, where one key may hold most of the rows.

A window runs a key in one task. Keys with more rows than a task's share are scanned otherwise: their rows are dealt by ranges
of (key, order), each range is scanned on its own, and what a key's earlier ranges amount to is added to its later ones."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..sources.shared import store as to_shared

PART = "__part"
LEAST = 10_000  # rows that any task can take in one window
RANGE = 500_000  # rows of a range, where shuffle partitions would be larger
_SPARK = {"sum": F.sum, "max": F.max, "min": F.min, "bit_xor": F.bit_xor}
_PYTHON = {"sum": lambda a, b: a + b, "max": max, "min": min, "bit_xor": lambda a, b: a ^ b}


def large_keys(df: DataFrame, key: list[str], limit: int | None = None) -> list[Row]:
    """Keys with more rows than ``limit``: by default twice a shuffle partition's share, so they are fewer than partitions."""
    if limit is None:
        limit = max(LEAST, 2 * df.count() // int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.groupBy(*key).agg(F.count("*").alias("__n")).where(F.col("__n") > limit).select(*key, "__n").collect()


def _same(left: DataFrame, right: DataFrame, key: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"__{k}"]) for k in key], F.lit(True))


def _spread(df: DataFrame, key: list[str], order: list[str], columns: dict[str, tuple[str, str]], store: Callable, rows: int) -> DataFrame:
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // RANGE + 1)
    dealt = store(df.repartitionByRange(parts, *key, *order).withColumn(PART, F.spark_partition_id()))
    here = Window.partitionBy(PART, *key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = dealt.groupBy(PART, *key).agg(*[_SPARK[f](c).alias(n) for n, (f, c) in columns.items()]).orderBy(PART)
    so_far: dict[tuple, dict] = {}
    carry = []
    for r in totals.collect():  # one for each range, and one more for each key
        k = tuple(r[x] for x in key)
        if k in so_far:
            carry.append((r[PART], *k, *so_far[k].values()))
        before = so_far.get(k, dict.fromkeys(columns))
        so_far[k] = {n: r[n] if before[n] is None else before[n] if r[n] is None else _PYTHON[f](before[n], r[n]) for n, (f, _) in columns.items()}
    names = ["__at", *[f"__{k}" for k in key], *[f"__c_{n}" for n in columns]]
    before = df.sparkSession.createDataFrame(carry, totals.schema).toDF(*names)
    out = dealt.withColumns({n: _SPARK[f](c).over(here) for n, (f, c) in columns.items()})
    out = out.join(F.broadcast(before), (F.col(PART) == F.col("__at")) & _same(out, before, key), "left")  # at most a row for each range

    def both(name: str, f: str) -> Column:
        mine, earlier = F.col(name), F.col(f"__c_{name}")
        if f in ("max", "min"):
            return (F.greatest if f == "max" else F.least)(mine, earlier)
        return F.when(earlier.isNull(), mine).when(mine.isNull(), earlier).otherwise(mine + earlier if f == "sum" else mine.bitwiseXOR(earlier))

    return out.select(*df.columns, *[both(n, f).alias(n) for n, (f, _) in columns.items()])


def running(df: DataFrame, key: list[str], order: list[str], columns: dict[str, tuple[str, str]], store: Callable = to_shared, limit: int | None = None, large: list[Row] | None = None) -> DataFrame:
    """``df`` with running aggregates up to and including each row. columns: name -> (function, column), the function
    one of sum, max, min, bit_xor. Rows that tie in (key, order) are taken in any order. ``df`` should be a stored table or a
    cheap view of one, as it is read more than once. ``large``: the result of ``large_keys``, where that is known."""
    large = large_keys(df, key, limit) if large is None else large
    here = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plain = {n: _SPARK[f](c).over(here) for n, (f, c) in columns.items()}
    if not large:
        return df.withColumns(plain)
    rows = sum(r["__n"] for r in large)
    if not key:
        return _spread(df, key, order, columns, store, rows)
    keys = df.sparkSession.createDataFrame([tuple(r[k] for k in key) for r in large], df.select(*key).schema).toDF(*[f"__{k}" for k in key])
    small = df.join(F.broadcast(keys), _same(df, keys, key), "left_anti")
    return small.withColumns(plain).union(_spread(df.join(F.broadcast(keys), _same(df, keys, key), "left_semi"), key, order, columns, store, rows))


def numbered(df: DataFrame, key: list[str], order: list[str], name: str, store: Callable = to_shared, limit: int | None = None) -> DataFrame:
    """``df`` with each row's place (from 1) in its key's order."""
    return running(df.withColumn("__one", F.lit(1).cast("long")), key, order, {name: ("sum", "__one")}, store, limit).drop("__one")


def since(df: DataFrame, key: list[str], order: list[str], counted: Column, reset: Column, name: str, store: Callable = to_shared, large: list[Row] | None = None) -> DataFrame:
    """``df`` with the count, up to each row, of rows for which ``counted`` holds since the last for which ``reset`` does, that one
    included. The counter as an associative pair (all counted, those counted at the last reset): a running sum and a running max."""
    large = large_keys(df, key) if large is None else large
    a = running(df.withColumn("__hit", F.coalesce(counted, F.lit(False)).cast("long")), key, order, {"__all": ("sum", "__hit")}, store, large=large)
    a = a.withColumn("__mark", F.when(reset, F.col("__all") - F.col("__hit")))
    a = running(store(a) if large else a, key, order, {"__base": ("max", "__mark")}, store, large=large)
    return a.withColumn(name, F.col("__all") - F.coalesce("__base", F.lit(0))).drop("__hit", "__all", "__mark", "__base")


def lagged(df: DataFrame, key: list[str], order: list[str], column: str, name: str, by: int = 1, store: Callable = to_shared, large: list[Row] | None = None) -> DataFrame:
    """``df`` with the column of the row ``by`` places before, null at the start. Large keys are numbered and joined by place."""
    large = large_keys(df, key) if large is None else large
    if not large:
        return df.withColumn(name, F.lag(column, by).over(Window.partitionBy(*key).orderBy(*order)))
    n = store(running(df.withColumn("__one", F.lit(1).cast("long")), key, order, {"__n": ("sum", "__one")}, store, large=large))
    before = n.select(*[F.col(k).alias(f"__{k}") for k in key], (F.col("__n") + by).alias("__m"), F.col(column).alias(name))
    return n.join(before, _same(n, before, key) & (n["__n"] == before["__m"]), "left").select(*df.columns, name)


def ranked_variants(df: DataFrame, family: list[str], variant: list[str], order: list[str], name: str, store: Callable = to_shared, limit: int | None = None) -> DataFrame:
    """``df`` with the place of each row's variant within its family, by the variants' first arrivals. Only first arrivals are
    ranked, by a scan; a variant that holds most rows is one of them."""
    first = store(df.groupBy(*family, *variant).agg(F.min(F.struct(*order)).alias("__first")))
    placed = numbered(first, family, ["__first"], "__place", store, limit).drop("__first")
    right = placed.toDF(*[f"__{c}" for c in placed.columns])
    return df.join(right, _same(df, right, [*family, *variant]), "left").select(*df.columns, F.col("____place").alias(name))
