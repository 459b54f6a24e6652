"""Operator 4: n-gram Jaccard join with Bayesian candidate pruning over MinHash values, exact verification, components."""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U, bound_batches, by_bytes, components, flat, forest, materialize, mix, part_count, words

BANDS, DEPTH = 32, 5  # at similarity 0.8 a pair shares no band with probability (1 - 0.8^5)^32 < 4e-6
STEP = 20  # MinHash values compared before each pruning decision
BLOCK = 384
CROWD = 1024  # classes in one band above which all of them are candidates of each other unseen


def shingles(codes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of runs of n words within each row, and the row of each; a row of fewer words has one shingle of them all."""
    count = np.diff(first)
    k = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
    row = np.repeat(np.arange(len(count)), k)
    at = first[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
    h = np.zeros(len(row), np.uint64)
    for i in range(n):
        inside = at + i < first[1:][row]
        c = codes[np.minimum(at + i, len(codes) - 1)] if len(codes) else h
        h = np.where(inside, mix(h * U(0x9E3779B97F4A7C15) + c), h)
    return h, row


def minhashes(h: np.ndarray, row: np.ndarray, rows: int, size: int) -> np.ndarray:
    """MinHash values (rows x size, uint32); rows without shingles get distinct-from-nothing zeros and must be skipped."""
    out = np.zeros((rows, size), np.uint32)
    if not len(h):
        return out
    starts = np.flatnonzero(np.r_[True, np.diff(row) != 0])
    seeds = np.random.Generator(np.random.PCG64(71)).integers(0, 2**63, size, dtype=np.uint64) * U(2) + U(1)
    x = h ^ (h >> U(31))
    for i, a in enumerate(seeds):
        out[row[starts], i] = np.minimum.reduceat(((x * a) >> U(32)).astype(np.uint32), starts)
    return out


def fewest_matches(n: int, threshold: float, tolerance: float) -> int:
    """Fewest equal values among n for which, under a uniform prior, similarity >= threshold keeps a posterior
    probability of at least ``tolerance``: the Beta(m + 1, n - m + 1) tail is the chance of at most m of n + 1 trials."""
    tail = 0.0
    for m in range(n + 1):
        tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if tail >= tolerance:
            return m
    return n


def likely_links(low: np.ndarray, group: np.ndarray, threshold: float, tolerance: float, at_once: int = 1 << 19) -> np.ndarray:
    """Of rows (lowest bytes of MinHash values) sorted by group, the root of each row in a spanning forest of the pairs of one
    group that the posterior does not rule out. A chance equality of the bytes only keeps a pair longer."""
    n = len(group)
    if not n:
        return np.zeros(0, np.int64)
    end = np.r_[np.flatnonzero(np.diff(group)) + 1, n]
    later = np.repeat(end, np.diff(np.r_[0, end])) - np.arange(n) - 1  # rows of the group after each
    sums, begin, us, vs = np.cumsum(later), 0, [], []
    while begin < n:
        stop = max(begin + 1, int(np.searchsorted(sums, (sums[begin - 1] if begin else 0) + at_once, side="right")))
        own = later[begin:stop]
        a = np.repeat(np.arange(begin, stop), own)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(own) - own, own)
        equal = np.zeros(len(a), np.int64)
        for at in range(0, low.shape[1], STEP):
            equal += (low[a, at : at + STEP] == low[b, at : at + STEP]).sum(axis=1)
            keep = equal >= fewest_matches(min(at + STEP, low.shape[1]), threshold, tolerance)
            a, b, equal = a[keep], b[keep], equal[keep]
        us.append(a)
        vs.append(b)
        begin = stop
    return forest(n, np.concatenate(us), np.concatenate(vs))


def similar_pairs(sig: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (one from left, one from right, a < b if they are the same block) of Jaccard similarity >= threshold."""
    same = left is right or np.array_equal(left, right)
    size = np.array([len(s) for s in sets])
    ok = np.triu(np.ones((len(left), len(right)), bool), 1) if same else np.ones((len(left), len(right)), bool)
    lo, hi = np.minimum(size[left][:, None], size[right][None, :]), np.maximum(size[left][:, None], size[right][None, :])
    ok &= lo >= threshold * hi - 1e-9
    a, b = np.nonzero(ok)
    equal = np.zeros(len(a), np.int64)
    for at in range(0, sig.shape[1], STEP):
        equal += (sig[left[a], at : at + STEP] == sig[right[b], at : at + STEP]).sum(axis=1)
        keep = equal >= fewest_matches(min(at + STEP, sig.shape[1]), threshold, tolerance)
        a, b, equal = a[keep], b[keep], equal[keep]
        if not len(a):
            return a, b
    rows, cols = np.unique(a), np.unique(b)
    used = np.unique(np.r_[left[rows], right[cols]])
    flatset = np.concatenate([sets[i] for i in used])
    owner = np.repeat(np.arange(len(used)), size[used])
    values, code, times = np.unique(flatset, return_inverse=True, return_counts=True)
    shared = times[code] > 1
    code, owner = code[shared], owner[shared]
    _, code = np.unique(code, return_inverse=True)
    width = int(code.max()) + 1 if len(code) else 0
    both = np.zeros((len(rows), len(cols)), np.float32)
    ri, ci = np.searchsorted(used, left[rows]), np.searchsorted(used, right[cols])
    for at in range(0, width, 8192):
        m = np.zeros((len(used), min(8192, width - at)), np.float32)
        inside = (code >= at) & (code < at + 8192)
        m[owner[inside], code[inside] - at] = 1
        both += m[ri] @ m[ci].T
    inter = both[np.searchsorted(rows, a), np.searchsorted(cols, b)].astype(np.int64)
    union = size[left[a]] + size[right[b]] - inter
    hit = inter >= threshold * union - 1e-9
    return a[hit], b[hit]


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8, tolerance: float = 1e-6) -> DataFrame:
    """One row per document: id, class_id (smallest id with the same text), n_links (other documents linked directly,
    copies included), component_id (smallest id reachable by links), kept (id = component_id).

    Shingles are the distinct runs of ``n`` words (white-space words, A-Z as a-z; a shorter text has one shingle of all
    its words). Equal texts are one class and always linked. Classes that share a band of MinHash values are compared value
    by value (lowest bytes) until the posterior rules the pair out; what remains, as a spanning forest of each band, joins
    classes to candidate groups, which hence are about the groups of true links and not all that share bands by chance.
    Bands of more than CROWD classes join all of them. Within a group, blocks of pairs are pruned by similarity of size,
    then by posterior on whole values, and the rest are verified by exact set intersection. No pair leaves its block: a
    block gives link counts and a spanning forest. Groups are cut into blocks of 384 classes, so one large group is many
    tasks.

    Null and empty texts, and texts of white space, have no shingles: they link with equal texts only (null counts as
    empty). Rows with a null id are dropped from linking and returned alone. A repeated id is one document with its
    smallest text. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    size = BANDS * DEPTH
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def bands(batches):
        for b in by_bytes(batches, "text"):
            data, off = flat(b.column("text"))
            h, row = shingles(*(lambda w: (w[0], w[3]))(words(data, off)), n)
            sig = minhashes(h, row, b.num_rows, size)
            keys = np.zeros((b.num_rows, BANDS), np.uint64)
            for i in range(DEPTH):
                keys = mix(keys * U(0x9E3779B97F4A7C15) + sig[:, i::DEPTH].astype(np.uint64) + U(i + 1))
            keys = mix(keys + np.arange(BANDS, dtype=np.uint64)[None, :]).view(np.int64)
            some = np.zeros(b.num_rows, bool)
            some[row] = True
            lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
            low = np.ascontiguousarray(sig.astype(np.uint8)).view(f"V{size}").ravel()
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("digest"), pa.array(some), lists, pa.array([x.tobytes() for x in low], pa.binary())], ["id", "digest", "some", "keys", "low"])

    signed = materialize(texts.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary")))).mapInArrow(bands, "id long, digest binary, some boolean, keys array<long>, low binary"))
    ids = signed.where("id is not null").groupBy("id").agg(F.min("digest").alias("digest"))
    classes = materialize(ids.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    chosen = signed.where("some").select(F.col("id").alias("rep"), "digest", "keys", "low").join(classes, ["rep", "digest"], "left_semi").dropDuplicates(["rep"])
    chosen = materialize(chosen.select("rep", "keys", "low"))
    met = chosen.select("rep", F.explode("keys").alias("key"))
    bands_of = met.groupBy("key").agg(F.min("rep").alias("least"), F.count("*").alias("k")).where("k > 1")
    shared = materialize(met.join(bands_of, "key"))
    parts = part_count(texts, 8.0, least=max(64, int(spark.conf.get("spark.sql.shuffle.partitions"))))  # follows the bytes of the texts
    seen = shared.where(F.col("k") <= CROWD).groupBy("rep").agg(F.collect_list("key").alias("shared"))
    seated = chosen.join(seen, "rep").select("rep", "low", F.explode("shared").alias("key")).withColumn("part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))

    def prune(table: pa.Table) -> pa.Table:
        key, rep = table.column("key").to_numpy(), table.column("rep").to_numpy()
        low = np.frombuffer(b"".join(table.column("low").to_pylist()), np.uint8).reshape(-1, size)
        order = np.lexsort((rep, key))
        root = likely_links(low[order], key[order], threshold, tolerance)
        hit = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"rep": rep[order[hit]], "low": rep[order[root[hit]]]})

    pruned = seated.groupBy("part").applyInArrow(prune, "rep long, low long")
    crowded = shared.where((F.col("k") > CROWD) & (F.col("rep") != F.col("least"))).select("rep", F.col("least").alias("low"))
    groups = materialize(components(pruned.union(crowded).distinct(), "rep", "low"))

    def sign(batches):
        for b in by_bytes(batches, "text"):
            data, off = flat(b.column("text"))
            codes, _, _, first = words(data, off)
            h, row = shingles(codes, first, n)
            sig = minhashes(h, row, b.num_rows, size)
            order = np.lexsort((h, row))
            h, row = h[order], row[order]
            keep = np.r_[True, (np.diff(row) != 0) | (h[1:] != h[:-1])] if len(h) else np.zeros(0, bool)
            h, row = h[keep], row[keep]
            cuts = np.searchsorted(row, np.arange(b.num_rows + 1))
            yield pa.RecordBatch.from_arrays(
                [b.column("rep"), b.column("root"), pa.array(np.diff(cuts)), pa.array([s.tobytes() for s in sig], pa.binary()), pa.array([h[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())],
                ["rep", "root", "size", "sig", "grams"],
            )

    chosen = groups.join(classes, F.col("node") == F.col("rep")).select("rep", "digest", "root")  # classes with a candidate
    full = texts.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary")))).join(chosen.withColumnRenamed("rep", "r"), (F.col("id") == F.col("r")) & (texts["id"].isNotNull()) & (chosen["digest"] == F.unhex(F.md5(F.col("text").cast("binary")))))
    full = full.select(F.col("id").alias("rep"), "text", "root").dropDuplicates(["rep"]).mapInArrow(sign, "rep long, root long, size long, sig binary, grams binary")
    members = groups.groupBy("root").agg(F.count("*").alias("k")).withColumn("chunks", F.ceil(F.col("k") / BLOCK).cast("int"))
    seats = full.join(members.select("root", "chunks"), "root").withColumn("mine", F.pmod(F.xxhash64("rep"), "chunks").cast("int"))
    seats = seats.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    seats = seats.select("root", "rep", "sig", "grams", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    seats = seats.join(classes.select("rep", "copies"), "rep").withColumn("part", F.pmod(F.xxhash64("root", "i", "j"), F.lit(parts)).cast("int"))

    def compare(table: pa.Table) -> pa.Table:
        f = {c: table.column(c).to_numpy() for c in ("root", "rep", "mine", "i", "j", "copies")}
        order = np.lexsort((f["rep"], f["j"], f["i"], f["root"]))
        f = {c: v[order] for c, v in f.items()}
        sig, grams = table.column("sig"), table.column("grams")
        cuts = np.flatnonzero(np.any([np.diff(f[c]) != 0 for c in ("root", "i", "j")], axis=0)) + 1
        us, vs, ns = [], [], []
        for run in np.split(np.arange(len(order)), cuts):
            if len(run) < 2:
                continue
            s = np.stack([np.frombuffer(sig[int(order[r])].as_py(), np.uint32) for r in run])
            sets = [np.frombuffer(grams[int(order[r])].as_py(), np.uint64) for r in run]
            whole = np.arange(len(run))
            i, j, mine = f["i"][run[0]], f["j"][run[0]], f["mine"][run]
            left, right = (whole, whole) if i == j else (whole[mine == i], whole[mine == j])
            a, b = similar_pairs(s, sets, left, right, threshold, tolerance)
            if not len(a):
                continue
            a, b = left[a], right[b]
            links, copies, rep = np.zeros(len(run), np.int64), f["copies"][run], f["rep"][run]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            root, hit = forest(len(run), a, b), np.flatnonzero(links)
            us.append(rep[hit])
            vs.append(rep[root[hit]])
            ns.append(links[hit])
        cat = lambda p: np.concatenate(p) if p else np.zeros(0, np.int64)
        return pa.table({"u": cat(us), "v": cat(vs), "n": cat(ns)})

    found = materialize(seats.groupBy("part").applyInArrow(compare, "u long, v long, n long"))
    counts = found.groupBy("u").agg(F.sum("n").alias("outer_links"))
    roots = components(found, "u", "v")
    per_class = (
        classes.join(counts, F.col("rep") == F.col("u"), "left")
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select("digest", F.col("rep").alias("class_id"), (F.col("copies") - 1 + F.coalesce("outer_links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    )
    linked = ids.join(per_class, "digest").select(F.col("id").alias(id_col), "class_id", "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
    null = F.lit(None).cast("long")
    alone = signed.where("id is null").select(null.alias(id_col), null.alias("class_id"), F.lit(0).cast("long").alias("n_links"), null.alias("component_id"), F.lit(True).alias("kept"))
    return linked.union(alone)


def op4_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_WORDS = r"list_filter(regexp_split_to_array(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
OP4_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cls AS (SELECT text, min(doc_id) AS rep, count(*) AS copies FROM d GROUP BY text),
w AS (SELECT rep, {_WORDS.format(t="text")} AS ws FROM cls),
g AS (SELECT DISTINCT rep, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))
      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
sz AS (SELECT rep, count(*) AS n FROM g GROUP BY rep),
inter AS (SELECT a.rep AS a, b.rep AS b, count(*) AS k FROM g a JOIN g b ON a.s = b.s AND a.rep <> b.rep GROUP BY 1, 2),
pairs AS (SELECT a, b FROM inter JOIN sz x ON x.rep = a JOIN sz y ON y.rep = b WHERE k * 10 >= 8 * (x.n + y.n - k)),
reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
roots AS (SELECT a, least(a, min(b)) AS root FROM reach GROUP BY a),
deg AS (SELECT a, sum(c.copies) AS n FROM pairs p JOIN cls c ON c.rep = p.b GROUP BY a)
SELECT d.doc_id, c.rep AS class_id, (c.copies - 1 + coalesce(deg.n, 0))::BIGINT AS n_links,
       coalesce(r.root, c.rep) AS component_id, d.doc_id = coalesce(r.root, c.rep) AS kept
FROM d JOIN cls c ON c.text = d.text LEFT JOIN roots r ON r.a = c.rep LEFT JOIN deg ON deg.a = c.rep
"""
