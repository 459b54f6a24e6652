"""Operator 12: mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.scan import numbered
from ..sources.shared import store

SHARD_WORDS = 1 << 18  # words and rows of a shard


def apportion(parties: DataFrame) -> DataFrame:
    """Sainte-Lague: (g, p, won) for parties (g: group, p: number, votes: double, most: seats it can fill, seats: its group's).

    A group's seats go one by one to the highest quotients votes / 1, votes / 3, votes / 5, ..., equal quotients to the smaller
    number; no party wins more than ``most``. If the parties cannot fill all seats, each wins its most. Parties without votes
    win none and have no row.

    No seat is dealt one by one: at a threshold x, a party has floor((votes / x + 1) / 2) quotients at or above it, so two
    thresholds close to votes per seat enclose the last seat with a few quotients of each party between them. Only these are
    listed and ranked, by a scan that spreads a group over tasks.
    """
    p = parties.where("votes > 0 AND most > 0")
    per = p.groupBy("g").agg(F.sum("votes").alias("all"), F.count("*").alias("k"), F.max("seats").alias("seats"), F.sum("most").alias("room"))
    p = store(p.drop("seats").join(per, "g"))
    full, open_ = p.where("seats >= room"), p.where("seats < room")

    def above(x: Column) -> Column:
        return F.least(F.col("most"), F.floor((F.col("votes") / x + 1) / 2))

    margin = 1.0
    while True:  # lower, until enough quotients lie above it whatever the limits take away
        low = F.col("all") / (2 * (F.col("seats") + F.col("k") * margin))
        if not open_.groupBy("g").agg(F.sum(above(low)).alias("n"), F.max("seats").alias("seats")).where("n < seats").limit(1).count():
            break
        margin *= 2
    spare = F.col("seats") - F.col("k")
    sure = F.when(spare > 0, above(F.col("all") / (2 * spare))).otherwise(0)
    p = open_.select("g", "p", "votes", "seats", sure.alias("sure"), above(low).alias("upto"))
    left = p.groupBy("g").agg((F.max("seats") - F.sum("sure")).alias("open"))
    listed = p.where("upto > sure").select("g", "p", "votes", F.explode(F.sequence(F.col("sure") + 1, F.col("upto"))).alias("seat"))
    ranked = numbered(listed.select("g", "p", (-F.col("votes") / (2 * F.col("seat") - 1)).alias("down")), ["g"], ["down", "p"], "place")
    more = ranked.join(left, "g").where("place <= open").groupBy("g", "p").agg(F.count("*").alias("more"))
    return p.join(more, ["g", "p"], "left").select("g", "p", (F.col("sure") + F.coalesce("more", F.lit(0))).alias("won")).union(full.select("g", "p", "most"))


def targets(sources: DataFrame, share: float, most: float) -> tuple[DataFrame, float]:
    """``sources`` (weight, source_size) with target, and the total: the weights share ``share`` times all sizes; targets stop
    at ``most`` times their source's size, and the excess is shared again by weight until none is above. Each round is
    one aggregation of the sources."""
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    cap, level, capped = F.col("source_size") * F.lit(float(most)), 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > cap
        full, weight, n = sources.agg(F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)), F.count_if(above)).first()
        if n == capped:
            break
        capped = n
        if weight:
            level = (total - full) / weight
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level))), total


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, block_words: int = 256, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Mix documents so that sources come near their targets: one row per document with doc_id, source, size (words
    ``[^\\x20\\x09-\\x0D]+``; null text: 0), source_size, target (its source's, see ``targets``), taken (words, repeats counted),
    passes (whole copies) and spans (word ranges taken once more).

    Sources in order of code points, null last, have the weights in turn. Blocks hold equal numbers of words: ``block_words``, less
    where the smallest target would not hold 256 blocks. Sainte-Lague gives each source its quota of the blocks, and each of a
    source's shards (documents by seeded hash, about 260,000 words and rows) its quota of the source's. In a
    shard, documents in seeded order are one ring of blocks: a quota is whole rounds of it, and a run of blocks from a seeded one. No
    document is taken more than ``most`` times. A source differs from its target by about a block.

    Repeated ids are documents of their own; those equal in id and size share a shard, and which of them is taken is open, not
    how many. Null ids are one id. An empty table gives no rows; other columns are ignored. Reruns agree.
    """
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col("size").cast("string")).cast("binary"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size")).withColumn("key", key)
    rows = store(rows)
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = numbered(store(sources.withColumn("none", F.col("source").isNull())), [], ["none", "source"], "rank")
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources, total = targets(store(sources.withColumn("weight", turn)), share, most)
    sources = store(sources)
    least = sources.where("target > 0").agg(F.min("target")).first()[0] or 1.0
    block = max(1, min(block_words, int(least // 256)))
    room = F.floor(F.col("words") * most / block)
    parties = sources.select(F.lit(0).alias("g"), F.col("rank").alias("p"), F.col("target").alias("votes"), F.floor(F.col("source_size") * most / block).alias("most"), F.lit(int(total // block)).alias("seats"))
    won = apportion(parties).select(F.col("p").alias("rank"), "won")
    sources = sources.withColumn("shards", F.ceil((F.col("source_size") + F.col("n")) / SHARD_WORDS))
    sources = store(sources.join(won, "rank", "left").withColumn("won", F.coalesce("won", F.lit(0))).withColumnRenamed("source", "s"))

    placed = rows.join(sources.select("s", "rank", "shards"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    placed = store(placed.select("doc_id", "source", "size", "key", "rank", F.pmod(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), F.col("shards")).alias("shard")))
    words = placed.groupBy("rank", "shard").agg(F.sum("size").alias("words"))
    shards = store(words.join(sources.select("rank", "won"), "rank"))
    quota = apportion(shards.select(F.col("rank").alias("g"), F.col("shard").alias("p"), F.col("words").cast("double").alias("votes"), room.alias("most"), F.col("won").alias("seats")))
    quota = shards.select("rank", "shard", "words").join(quota.select(F.col("g").alias("rank"), F.col("p").alias("shard"), "won"), ["rank", "shard"], "left")
    take = F.coalesce("won", F.lit(0)) * block
    first = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("rank").cast("string"), F.col("shard").cast("string")).cast("binary"))
    start = F.pmod(F.conv(F.substring(first, 1, 8), 16, 10).cast("long"), F.greatest(F.lit(1), F.ceil(F.col("words") / block))) * block
    quota = quota.select(
        "rank", "shard", "words", start.alias("start"), F.when(F.col("words") > 0, F.floor(take / F.col("words"))).otherwise(0).alias("passes"),
        F.when(F.col("words") > 0, F.pmod(take, F.col("words"))).otherwise(0).alias("more"),
    )

    at = placed.withColumn("to", F.sum("size").over(Window.partitionBy("rank", "shard").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    at = at.withColumn("from", F.col("to") - F.col("size")).join(quota, ["rank", "shard"])

    def within(a: Column, b: Column) -> Column:
        lo = F.least(F.greatest(F.col("from"), a), F.col("to"))
        return F.struct((lo - F.col("from")).alias("from"), (F.greatest(lo, F.least(F.col("to"), b)) - F.col("from")).alias("to"))

    wrapped = F.array(within(F.lit(0), F.col("start") + F.col("more") - F.col("words")), within(F.col("start"), F.col("start") + F.col("more")))
    at = at.withColumn("spans", F.filter(wrapped, lambda s: s["to"] > s["from"]))
    taken = F.col("passes") * F.col("size") + F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["to"] - s["from"])
    return at.join(sources.select("rank", "source_size", "target"), "rank").select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "passes", "spans")


def op12_source_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


# Sainte-Lague by listing all quotients; the shards of the mix hold 2^18 words and rows
OP12_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, size, md5('11:' || coalesce(doc_id::VARCHAR, '') || ':' || size::VARCHAR) AS key
  FROM (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents)),
s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n, row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM d GROUP BY source),
w AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
t AS (SELECT 1.5::DOUBLE * sum(source_size)::DOUBLE AS total, sum(weight) AS weights FROM w),
l AS (
  SELECT rank, cap / weight AS ratio, (total - coalesce(sum(cap) OVER o, 0)) / nullif(weights - coalesce(sum(weight) OVER o, 0), 0) AS level
  FROM w, t WINDOW o AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, rank LIMIT 1),
g AS (SELECT w.*, least(cap, weight * level) AS target FROM w, v),
b AS (SELECT greatest(1, least(256, floor(coalesce(min(target) FILTER (WHERE target > 0), 1) / 256)))::BIGINT AS block FROM g),
q1 AS (SELECT rank, target / (2 * k - 1) AS q, k FROM (SELECT rank, target, unnest(range(1, floor(2 * source_size / block)::BIGINT + 1)) AS k FROM g, b WHERE target > 0)),
won AS (SELECT rank, count(*) AS won FROM (SELECT *, row_number() OVER (ORDER BY q DESC, rank) AS i FROM q1), t, b WHERE i <= floor(total / block) GROUP BY rank),
a AS (SELECT g.*, coalesce(won, 0) AS won, ceil((source_size + n) / {SHARD_WORDS})::BIGINT AS shards FROM g LEFT JOIN won USING (rank)),
p AS (SELECT d.*, a.rank, a.source_size, a.target, ('0x' || substr(key, 1, 8))::BIGINT % shards AS shard FROM d JOIN a ON d.source IS NOT DISTINCT FROM a.source),
h AS (SELECT rank, shard, sum(size)::BIGINT AS words FROM p GROUP BY ALL),
q2 AS (SELECT rank, shard, words::DOUBLE / (2 * k - 1) AS q FROM (SELECT rank, shard, words, unnest(range(1, floor(2 * words / block)::BIGINT + 1)) AS k FROM h, b)),
w2 AS (SELECT q.rank, shard, count(*) AS won FROM (SELECT *, row_number() OVER (PARTITION BY rank ORDER BY q DESC, shard) AS i FROM q2) q JOIN a ON q.rank = a.rank WHERE i <= a.won GROUP BY ALL),
u AS (
  SELECT h.rank, h.shard, words, coalesce(won, 0) * block AS take, ('0x' || substr(md5('11:' || h.rank || ':' || h.shard), 1, 8))::BIGINT % greatest(1, ceil(words / block)::BIGINT) * block AS start
  FROM h LEFT JOIN w2 ON h.rank = w2.rank AND h.shard = w2.shard, b),
x AS (SELECT *, CASE WHEN words > 0 THEN take // words ELSE 0 END AS passes, CASE WHEN words > 0 THEN take % words ELSE 0 END AS more FROM u),
y AS (SELECT p.*, sum(size) OVER (PARTITION BY rank, shard ORDER BY key ROWS UNBOUNDED PRECEDING)::BIGINT AS hi FROM p)
SELECT doc_id, size, source_size, target, (passes * size + greatest(0, least(hi, start + more) - greatest(hi - size, start)) + greatest(0, least(hi, start + more - words) - greatest(hi - size, 0)))::BIGINT AS taken
FROM y JOIN x ON y.rank = x.rank AND y.shard = x.shard"""
