"""Operator 1: sharding by sampled splitters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

FINE = 64  # a group of equal texts above 1/FINE of a shard is placed on its own


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", seed: int = 17) -> DataFrame:
    """Range-partition rows by the hash of their text into ``shards`` shards of near-equal bytes; equal texts share a shard.

    Splitters are quantiles of a size-weighted key sample; exact sums of the ranges between them give the shard
    boundaries. A group of equal texts (or a text) above 1/64 of a shard's bytes or rows is cut into pieces that are
    placed first, all in the lightest shard, or one by one if the group exceeds a shard (an overfull range is subdivided).
    The driver sees only the sample, range sums and pieces, each bounded by ``shards`` or by rows / 50,000.

    Null text: size 1, crc32 of nothing (0), with the empty texts. Repeated ids are rows like any other; null ids too.
    An empty table gives no rows. Other columns are ignored. Returns id, size, text_crc32, shard, slot (gapless from 0).
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = materialize(docs.select(F.col(id_col), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h")))
    total, rows = base.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    if not rows:
        return base.select(id_col, "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    grain = shards * FINE
    large = base.groupBy("h").agg(F.sum("size").alias("s"), F.count("*").alias("n")).where((F.col("s") * grain > total) | (F.col("n") * grain > rows)).collect()
    salts = spark.createDataFrame([(g.h, max(1, int(np.ceil(max(g.s / total, g.n / rows) * grain)))) for g in large], "h long, salts long")
    marked = base.join(F.broadcast(salts), "h", "left").withColumn("salt", F.when(F.col("salts").isNotNull(), F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), "salts")))
    pieces = marked.where("salt is not null").groupBy("h", "salt").agg(F.sum("size").alias("s"), F.count("*").alias("n")).orderBy("h", "salt").collect() if large else []

    load, held = np.zeros(shards), np.zeros(shards, np.int64)
    units: list[list] = []
    for g in large:
        own = [p for p in pieces if p.h == g.h]
        units += [own] if g.s * shards <= total else [[p] for p in own]
    placed = []
    for unit in sorted(units, key=lambda u: (-sum(p.s for p in u), u[0].h, u[0].salt)):
        k = int(np.argmin(load))
        for p in unit:
            placed.append((p.h, p.salt, k, int(held[k])))
            load[k] += p.s
            held[k] += p.n
    at = spark.createDataFrame(placed, "h long, salt long, shard int, first long")
    fixed = (
        marked.where("salt is not null")
        .join(F.broadcast(at), ["h", "salt"])
        .select(id_col, "size", "text_crc32", "shard", (F.col("first") + F.row_number().over(Window.partitionBy("h", "salt").orderBy(id_col)) - 1).alias("slot"))
    )

    rest = marked.where("salts is null").select(id_col, "size", "text_crc32", "h")
    ranges = int(min(65536, max(grain // 4, rows / 50_000)))
    chance = (F.xxhash64(F.col(id_col), F.lit(seed + 1)).bitwiseAND(F.lit(2**53 - 1)) / float(2**53)) < F.col("size") * (16.0 * ranges / total)
    sample = np.sort(np.array([r.h for r in rest.where(chance).select("h").collect()], np.int64))
    splitters = np.unique(sample[(np.arange(1, ranges) * len(sample)) // ranges]) if len(sample) else sample

    @F.pandas_udf("long")
    def range_of(h: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, h.to_numpy(np.int64), side="right"))

    ranged = rest.withColumn("rng", range_of("h"))
    w = Window.partitionBy("rng")
    ranked = ranged.withColumns(
        {"before": F.coalesce(F.sum("size").over(w.orderBy("h").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0)), "rank": F.row_number().over(w.orderBy("h", id_col)) - 1}
    )
    sums = ranged.groupBy("rng").agg(F.sum("size").alias("s"), F.count("*").alias("n")).orderBy("rng").collect()
    sizes, counts = np.array([r.s for r in sums], np.int64), np.array([r.n for r in sums], np.int64)
    starts = spark.createDataFrame(
        [(r.rng, int(a), int(b)) for r, a, b in zip(sums, np.cumsum(sizes) - sizes, np.cumsum(counts) - counts, strict=True)], "rng long, size_at long, count_at long"
    )
    small = float(sizes.sum())
    level = total / shards
    quota = np.maximum(level - load, 0)
    bounds = np.cumsum(quota * (small / quota.sum() if quota.sum() else 1))[:-1]
    here = F.col("before") + F.col("size_at")
    shard = sum(((here >= F.lit(float(b))).cast("int") for b in bounds), F.lit(0)) if len(bounds) else F.lit(0)
    spread = materialize(ranked.join(F.broadcast(starts), "rng").select(id_col, "size", "text_crc32", shard.alias("shard"), (F.col("rank") + F.col("count_at")).alias("rank")))
    first = {r.shard: r.first for r in spread.groupBy("shard").agg(F.min("rank").alias("first")).collect()}
    shift = spark.createDataFrame([(k, int(held[k]) - first[k]) for k in first], "shard int, shift long")
    return spread.join(F.broadcast(shift), "shard").select(id_col, "size", "text_crc32", "shard", (F.col("rank") + F.col("shift")).alias("slot")).union(fixed)


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    out = shard_by_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
