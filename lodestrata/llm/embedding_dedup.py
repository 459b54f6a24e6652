"""Operator 2: embedding near-duplicates by random-hyperplane sign hashing, exact cosine and connected components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U, components, forest, materialize, mix, part_count

BITS = 18  # hyperplanes of a table, for up to 2^22 classes; one more for each doubling keeps buckets small
MISS = 1e-5  # chance that a pair at the threshold shares no table
BLOCK = 1024


def tables_for(threshold: float, bits: int) -> int:
    """Tables that keep the chance of missing a pair at ``threshold`` below MISS: (1 - (1 - acos(threshold) / pi)^bits)^tables."""
    meet = (1 - np.arccos(threshold) / np.pi) ** bits
    return int(np.ceil(np.log(MISS) / np.log1p(-meet)))


def signatures(x: np.ndarray, tables: int, bits: int, seed: int) -> np.ndarray:
    """Sign patterns of the rows of x against ``tables`` x ``bits`` random hyperplanes."""
    planes = np.random.Generator(np.random.PCG64([seed, x.shape[1]])).standard_normal((x.shape[1], tables * bits))
    signs = (x @ planes >= 0).reshape(len(x), tables, bits)
    return (signs * (1 << np.arange(bits))).sum(axis=2).astype(np.uint64)


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows over their largest component, so that no square of very small or large ones vanishes or overflows."""
    return x / np.abs(x).max(axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def near_vectors(vectors: DataFrame, threshold: float = 0.98, bits: int | None = None, seed: int = 5) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept, class_id.

    Equal vectors of a label are one class. Classes that share a sign pattern in some table are compared block by block
    by exact cosine in double precision; a pair counts in the first table where it meets, so no pair is ever emitted.
    Buckets above 1024 classes are split into pairs of chunks; hyperplanes grow with the logarithm of the classes, and tables
    with them. Vectors link only within equal, non-null labels and
    equal lengths. Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, copies
    included; so do rows with a null id. A repeated id is one vector: its smallest row by value counts, and it is
    returned once. An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    every = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("x"), "label")
    rows = every.where("vec_id is not null").groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("r")).select("vec_id", "r.x", "r.label")
    rows = rows.union(every.where("vec_id is null"))
    sound = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0)
    rows = rows.withColumn("ok", F.coalesce(sound & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False)))
    classes = materialize(rows.where("ok").groupBy("label", "x").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")))

    n = classes.count()
    bits = bits or min(30, max(BITS, BITS + int(np.ceil(np.log2(max(n, 1)))) - 22))
    tables = tables_for(threshold, bits)

    def sign(batches):
        for b in batches:
            x = b.column("x").to_numpy(zero_copy_only=False)
            sizes = np.array([len(v) for v in x], np.int64)
            for d in np.unique(sizes):
                at = np.flatnonzero(sizes == d)
                s = signatures(scaled(np.stack([np.asarray(x[i], np.float64) for i in at])), tables, bits, seed)
                label = np.asarray(b.column("label").to_numpy(zero_copy_only=False))[at].astype(np.int64).astype(np.uint64)
                keys = mix(mix(label[:, None] * U(0x9E3779B97F4A7C15) + U(d)) + (s << U(8)) + np.arange(tables, dtype=np.uint64)[None, :]).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * tables), pa.array(keys.ravel()))
                rest = b.select(["rep", "n", "x"]).take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*rest.columns, lists, pa.array([r.tobytes() for r in s.astype(np.uint32)], pa.binary())], ["rep", "n", "x", "keys", "sig"])

    signed = materialize(classes.mapInArrow(sign, "rep long, n long, x array<double>, keys array<long>, sig binary"))
    met = signed.select("rep", F.posexplode("keys").alias("t", "key"))
    crowded = met.groupBy("key", "t").agg(F.count("*").alias("k")).where("k > 1")
    seats = met.join(crowded, ["key", "t"]).withColumn("chunks", F.ceil(F.col("k") / BLOCK).cast("int"))
    seats = seats.withColumn("mine", F.pmod(F.xxhash64("rep"), "chunks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    seats = seats.select("key", "t", "rep", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    parts = part_count(signed, 4.0 / tables, least=max(64, int(spark.conf.get("spark.sql.shuffle.partitions"))))  # a class travels once for each table at most
    seated = seats.join(signed.drop("keys"), "rep").withColumn("part", F.pmod(F.xxhash64("key", "i", "j"), F.lit(parts)).cast("int"))

    def compare(table: pa.Table) -> pa.Table:
        us, vs, ns = [], [], []
        frame = {c: table.column(c).to_numpy() for c in ("key", "t", "rep", "mine", "i", "j", "n")}
        xs = table.column("x").to_pandas().to_numpy()
        sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(-1, tables)
        order = np.lexsort((frame["rep"], frame["j"], frame["i"], frame["t"], frame["key"]))
        frame = {c: v[order] for c, v in frame.items()}
        xs, sigs = xs[order], sigs[order]
        cuts = np.flatnonzero(np.any([np.diff(frame[c]) != 0 for c in ("key", "t", "i", "j")], axis=0)) + 1
        for run in np.split(np.arange(len(order)), cuts):
            if len(run) < 2:
                continue
            x = scaled(np.stack(xs[run]))
            norm = np.sqrt((x * x).sum(axis=1))
            near = (x @ x.T) / norm[:, None] / norm[None, :] >= threshold
            i, j, mine = frame["i"][run[0]], frame["j"][run[0]], frame["mine"][run]
            near &= np.triu(np.ones_like(near), 1)
            if i != j:
                near &= mine[:, None] != mine[None, :]
            a, b = np.nonzero(near)
            if not len(a):
                continue
            s, t = sigs[run], int(frame["t"][run[0]])
            if t:  # a pair that met in an earlier table was counted there
                fresh = np.ones(len(a), bool)
                for k in range(t):
                    fresh &= s[a, k] != s[b, k]
                a, b = a[fresh], b[fresh]
            links = np.zeros(len(run), np.int64)
            np.add.at(links, a, frame["n"][run][b])
            np.add.at(links, b, frame["n"][run][a])
            root, rep = forest(len(run), a, b), frame["rep"][run]
            hit = np.flatnonzero(links)
            us.append(rep[hit])
            vs.append(rep[root[hit]])
            ns.append(links[hit])
        cat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return pa.table({"u": cat(us), "v": cat(vs), "n": cat(ns)})

    found = materialize(seated.select("part", "key", "t", "rep", "mine", "i", "j", "n", "x", "sig").groupBy("part").applyInArrow(compare, "u long, v long, n long"))
    counts = found.groupBy("u").agg(F.sum("n").alias("outer_links"))
    groups = components(found, "u", "v")
    per_class = (
        classes.select("label", "x", "rep", "n")
        .join(counts, F.col("rep") == F.col("u"), "left")
        .join(groups, F.col("rep") == F.col("node"), "left")
        .select("label", "x", "rep", (F.col("n") - 1 + F.coalesce("outer_links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    )
    linked = rows.where("ok").join(per_class, ["label", "x"]).select("vec_id", "n_links", "component_id", F.col("rep").alias("class_id"))
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").alias("class_id"))
    return linked.union(alone).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"), "class_id")


def op2_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP2_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
ok AS (
  SELECT * FROM v WHERE label IS NOT NULL AND x IS NOT NULL AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0
  AND len(list_filter(x, lambda e: e <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x) / sqrt(list_dot_product(a.x, a.x)) / sqrt(list_dot_product(b.x, b.x)) >= 0.98),
reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
roots AS (SELECT a, least(a, min(b)) AS root FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM pairs GROUP BY a),
copies AS (SELECT label, x, min(vec_id) AS rep FROM ok GROUP BY label, x)
SELECT v.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, coalesce(r.root, v.vec_id) AS component_id,
       v.vec_id = coalesce(r.root, v.vec_id) AS kept, coalesce(c.rep, v.vec_id) AS class_id
FROM v LEFT JOIN degree d ON d.a = v.vec_id LEFT JOIN roots r ON r.a = v.vec_id
LEFT JOIN ok o ON o.vec_id = v.vec_id LEFT JOIN copies c ON c.label = o.label AND c.x = o.x
"""
