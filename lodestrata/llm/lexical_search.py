"""Operator 11: ranked lexical search over shards of dual-sorted wavelet trees."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import shared_dir
from .common import LOWER, bound_batches, by_bytes, flat, pack, prefix_codes, span_codes, unpack

TERM = np.zeros(256, dtype=bool)
TERM[48:58] = TERM[65:91] = TERM[97:123] = TERM[128:] = True
SHARD = 4 << 20  # bytes of text in a shard, but for longer single texts
BLOCK = 4 << 20  # bytes of query terms that are searched in one pass
WIDTH = 64  # nodes expanded together
PROBE = 16  # one shard in so many is searched first, for lower bounds
NO_ID = np.int64(2**63 - 1)  # a null id sorts last


def terms_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit codes of the terms (maximal runs of ASCII letters, digits and all bytes above 127; A-Z count as a-z), row after
    row, and each row's count."""
    inside = TERM[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    inner = off[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    start[inner] = inside[inner]
    end[inner - 1] = inside[inner - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return span_codes(prefix_codes(LOWER[data]), s, e), np.diff(np.searchsorted(s, off))


def _postings(batches):
    """A row for each shard: its rows' ids in ascending order, their lengths, and the lists of (row, occurrences) by term."""
    for b in by_bytes(batches, "text", SHARD):
        data, off = flat(b.column("text"))
        codes, n = terms_of(data, off)
        col = b.column("id")
        null = col.is_null().to_numpy(zero_copy_only=False)
        ids = np.where(null, NO_ID, col.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        order = np.lexsort((n, null, ids))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        terms, which = np.unique(codes, return_inverse=True)
        key = np.sort(which.astype(np.int64) * len(order) + np.repeat(place, n))
        at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        tf = np.diff(np.r_[at, len(key)])
        term, doc = np.divmod(key[at], len(order))
        yield pa.RecordBatch.from_pydict(
            {
                "n_docs": [int((n > 0).sum())],
                "n_terms": [int(n.sum())],
                "pick": pa.array([int(codes.sum(dtype=np.uint64) % np.uint64(PROBE)) if len(codes) else 0], pa.int32()),
                "ids": [pack(ids[order], null[order].astype(np.uint8))],
                "lengths": [pack(n[order].astype(np.int64))],
                "terms": [pack(terms, np.bincount(term, minlength=len(terms)).astype(np.uint32))],
                "postings": [pack(doc.astype(np.uint32), tf.astype(np.uint32))],
            }
        )


POSTINGS = "n_docs long, n_terms long, pick int, ids binary, lengths binary, terms binary, postings binary"
TREE = "pick int, ids binary, terms binary, n_postings long, levels int, bits binary, impacts binary"


def _trees(batches, n_docs: int, n_terms: int):
    """Each shard's lists by descending impact, laid end to end as one sequence of row numbers, as the levels of a wavelet tree:
    level by level the sequence is split stably by the next bit of the row number, so every node of the tree (a range of row
    numbers) holds each term's list by descending impact, and rows can be navigated by id."""
    for b in batches:
        for row in b.to_pylist():
            (n,) = unpack(row["lengths"], [np.int64])
            terms, sizes = unpack(row["terms"], [np.uint64, np.uint32])
            doc, tf = unpack(row["postings"], [np.uint32, np.uint32])
            m = 100 - 75 + (75 * n * n_docs) // max(n_terms, 1)
            tf = tf.astype(np.int64)
            impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[doc])
            term = np.repeat(np.arange(len(terms), dtype=np.int64), sizes)
            order = np.argsort(term * (1 << 20) - impact, kind="stable")  # impacts stay below 2^20
            seq, levels = doc[order], max(1, int(len(n) - 1).bit_length())
            bits = []
            for k in range(levels - 1, -1, -1):
                bit = (seq >> np.uint32(k)) & np.uint32(1) > 0
                bits.append(np.packbits(bit))
                seq = np.concatenate([seq[~bit], seq[bit]])
            yield pa.RecordBatch.from_pydict(
                {
                    "pick": pa.array([row["pick"]], pa.int32()),
                    "ids": [row["ids"]],
                    "terms": [row["terms"]],
                    "n_postings": [len(doc)],
                    "levels": pa.array([levels], pa.int32()),
                    "bits": [pack(np.concatenate(bits))],
                    "impacts": [pack(impact[order].astype(np.uint32))],
                }
            )


@dataclass
class LexicalIndex:
    """Shards of a table's texts: ``trees`` is a stored DataFrame of one row for each shard. n_docs counts the texts that hold
    a term, n_terms all their terms."""

    trees: DataFrame
    n_docs: int
    n_terms: int


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Rows weigh megabytes: small row groups bound what a reader holds."""
    import uuid

    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "uncompressed").option("parquet.block.size", 16 << 20).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LexicalIndex:
    """Index every row. Shards are runs of rows of about 4 MB as the table is read, so nothing is shuffled; a longer text is a
    shard of its own. Null texts hold no terms. Repeated ids and null ids are rows like any other; other columns are ignored."""
    bound_batches(docs.sparkSession)
    lists = _stored(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_postings, POSTINGS), "postings")
    n_docs, n_terms = lists.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    trees = lists.drop("n_docs", "n_terms").where(F.lit(n_docs > 0)).mapInArrow(lambda b: _trees(b, n_docs, n_terms), TREE)
    return LexicalIndex(_stored(trees, "trees"), n_docs, n_terms)


class Shard:
    """A shard in memory: at each level of its tree the count of zero bits before each place, and the impacts in that order."""

    def __init__(self, row: dict):
        self.ids, self.null = unpack(row["ids"], [np.int64, np.uint8])
        self.terms, sizes = unpack(row["terms"], [np.uint64, np.uint32])
        self.starts = np.r_[0, np.cumsum(sizes.astype(np.int64))]
        n, self.levels = row["n_postings"], row["levels"]
        (packed,) = unpack(row["bits"], [np.uint8])
        (impact,) = unpack(row["impacts"], [np.uint32])
        self.stride, width = n + 1, (n + 7) // 8
        self.zeros = np.zeros((self.levels, n + 1), np.int32)
        self.impacts = np.zeros((self.levels + 1, n + 1), np.int32)
        self.impacts[0, :n] = impact
        for k in range(self.levels):
            bit = np.unpackbits(packed[k * width : (k + 1) * width], count=n).astype(bool)
            np.cumsum(~bit, out=self.zeros[k, 1:])
            z = self.zeros[k, n]
            self.impacts[k + 1, :z], self.impacts[k + 1, z:n] = self.impacts[k, :n][~bit], self.impacts[k, :n][bit]
        self.ends = self.zeros[:, n].astype(np.int64)
        self.zeros, self.impacts = self.zeros.ravel(), self.impacts.ravel()

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which codes the shard holds, and where in its terms."""
        at = np.searchsorted(self.terms, codes)
        at[at == len(self.terms)] = 0
        held = self.terms[at] == codes if len(self.terms) else np.zeros(len(codes), bool)
        return held, at[held]

    def bounds(self, level: np.ndarray, lo: np.ndarray, hi: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Most that a row below each node can score: the terms' first, hence greatest, impacts there."""
        first = self.impacts[level[:, None] * self.stride + lo]
        return np.where(hi > lo, first, 0).astype(np.int64) @ weight

    def search(self, at: np.ndarray, weight: np.ndarray, top: "Top") -> None:
        """Best-first: nodes of greatest bound are taken WIDTH at a time; nodes that cannot enter the top are dropped. A leaf's
        bound is its row's score."""
        level, prefix = np.zeros(1, np.int64), np.zeros(1, np.int64)
        lo, hi = self.starts[at][None, :], self.starts[at + 1][None, :]
        bound = self.bounds(level, lo, hi, weight)
        while True:
            first = np.minimum(prefix << (self.levels - level), len(self.ids) - 1)
            alive = top.admits(bound, self.ids[first])
            level, prefix, lo, hi, bound = level[alive], prefix[alive], lo[alive], hi[alive], bound[alive]
            if not len(bound):
                return
            best = np.zeros(len(bound), bool)
            best[np.argpartition(-bound, WIDTH)[:WIDTH] if len(bound) > WIDTH else slice(None)] = True
            leaf = best & (level == self.levels)
            if leaf.any():
                top.add(bound[leaf], self.ids[prefix[leaf]], self.null[prefix[leaf]])
            go = best & ~leaf
            k, a, b = level[go], lo[go], hi[go]
            base = k[:, None] * self.stride
            a0, b0 = self.zeros[base + a].astype(np.int64), self.zeros[base + b].astype(np.int64)
            z = self.ends[k][:, None]
            rest = ~best
            new = [np.concatenate([k, k]) + 1, np.concatenate([prefix[go] * 2, prefix[go] * 2 + 1]), np.concatenate([a0, z + a - a0]), np.concatenate([b0, z + b - b0])]
            level, prefix, lo, hi = (np.concatenate([old[rest], x]) for old, x in zip((level, prefix, lo, hi), new, strict=True))
            bound = np.concatenate([bound[rest], self.bounds(new[0], new[2], new[3], weight)])


class Top:
    """The k best (score, id) of a query so far: highest scores, ascending ids, null ids last."""

    def __init__(self, k: int, scores=(), ids=(), null=()):
        self.k = k
        self.score, self.id, self.null = np.array(scores, np.int64), np.array(ids, np.int64), np.array(null, np.uint8)
        self.fresh = np.zeros(len(self.score), bool)

    def admits(self, bound: np.ndarray, first_id: np.ndarray) -> np.ndarray:
        if len(self.score) < self.k:
            return bound > 0
        return (bound > max(self.score[-1], 0)) | ((bound == self.score[-1]) & (first_id < self.id[-1]))

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        s, i, n, f = np.r_[self.score, score], np.r_[self.id, ids], np.r_[self.null, null], np.r_[self.fresh, np.ones(len(score), bool)]
        order = np.lexsort((n, i, -s))[: self.k]
        self.score, self.id, self.null, self.fresh = s[order], i[order], n[order], f[order]


def _searched(batches, queries: list, k: int, before: dict):
    """Each query's best rows of the task's shards, those that ``before`` gives left out. queries: (number, codes, weights)."""
    tops = {q: Top(k, *before.get(q, ((), (), ()))) for q, _, _ in queries}
    for b in batches:
        for row in b.to_pylist():
            shard = Shard(row)
            for q, codes, weight in queries:
                held, at = shard.find(codes)
                if len(at):
                    shard.search(at, weight[held], tops[q])
    out = [(q, t.score[t.fresh], t.id[t.fresh], t.null[t.fresh]) for q, t in tops.items() if t.fresh.any()]
    if out:
        cat = lambda i: np.concatenate([x[i] for x in out])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([x[0] for x in out], [len(x[1]) for x in out])), pa.array(cat(1)), pa.array(cat(2), mask=cat(3) > 0)], ["q", "score", "id"])


def _query_terms(batches):
    for b in by_bytes(batches, "text", SHARD):
        data, off = flat(b.column("text"))
        codes, n = terms_of(data, off)
        cuts = np.r_[0, np.cumsum(n)]
        each = [np.unique(codes[i:j], return_counts=True) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("item"), pa.array([c.tobytes() for c, _ in each], pa.binary()), pa.array([r.astype(np.int64).tobytes() for _, r in each], pa.binary())], ["item", "codes", "repeats"])


def _best(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id")))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def search(index: LexicalIndex, queries: DataFrame, k: int = 10, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank from 1, doc_id, score) of the k best rows of each query, exactly: integer scores above 0, equal ones by
    ascending doc_id, null ids last.

    Rows with one item_id (null included) are one query, whose text is the least. Queries without terms, or none, give no
    rows. Queries are searched in blocks of about 4 MB of terms, each broadcast and run against all shards. Of each
    block, document frequencies are summed over the shards' dictionaries; one shard in 16 is searched first, and its best k are
    bounds for the others; a task carries its best from shard to shard. A term is known by a 64-bit code: that any of a
    query's terms meets another's code among 1e9 terms has probability below 1e-8 a term."""
    spark = queries.sparkSession
    bound_batches(spark)
    texts = queries.groupBy(F.col(item_col).alias("item")).agg(F.min(text_col).alias("text"))
    parsed = _stored(texts.mapInArrow(_query_terms, f"item {queries.schema[item_col].dataType.simpleString()}, codes binary, repeats binary"), "queries")
    total = parsed.agg(F.coalesce(F.sum(F.octet_length("codes")), F.lit(0))).first()[0] * 2
    blocks, out = int(total // BLOCK) + 1, None
    for block in range(blocks if index.n_docs else 0):
        rows = parsed.where((F.pmod(F.xxhash64("item"), F.lit(blocks)) == block) & (F.octet_length("codes") > 0)).collect()
        if not rows:
            continue
        asked = np.unique(np.concatenate([np.frombuffer(r.codes, np.uint64) for r in rows]))

        def frequencies(batches, asked=asked):
            total = np.zeros(len(asked), np.int64)
            for b in batches:
                for blob in b.column("terms"):
                    terms, sizes = unpack(blob.as_py(), [np.uint64, np.uint32])
                    at = np.searchsorted(terms, asked)
                    at[at == len(terms)] = 0
                    total += np.where(terms[at] == asked, sizes[at], 0) if len(terms) else 0
            hit = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["t", "n"])

        df = np.zeros(len(asked), np.int64)
        for r in index.trees.select("terms").mapInArrow(frequencies, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).collect():
            df[r.t] = r.n
        weight = np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * int(x) + 1))) if x else 0 for x in df], np.int64)
        todo = []
        for q, r in enumerate(rows):
            codes, repeats = np.frombuffer(r.codes, np.uint64), np.frombuffer(r.repeats, np.int64)
            w = weight[np.searchsorted(asked, codes)] * repeats
            todo.append((q, codes[w > 0], w[w > 0]))
        schema = "q long, score long, id long"
        probed = _best(index.trees.where("pick = 0").mapInArrow(lambda b, todo=todo: _searched(b, todo, k, {}), schema), k).orderBy("q", "rank").collect()
        before: dict[int, tuple] = {}
        for r in probed:
            for x, v in zip(before.setdefault(r.q, ([], [], [])), (r.score, NO_ID if r.id is None else r.id, r.id is None), strict=True):
                x.append(v)
        rest = index.trees.where("pick <> 0").mapInArrow(lambda b, todo=todo, before=before: _searched(b, todo, k, before), schema)
        first = spark.createDataFrame([(r.q, r.score, r.id) for r in probed], schema)
        names = spark.createDataFrame([(q, r["item"]) for q, r in enumerate(rows)], f"q long, {item_col} {parsed.schema['item'].dataType.simpleString()}")
        found = _best(rest.union(first), k).join(F.broadcast(names), "q").select(item_col, F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score")
        out = found if out is None else out.union(found)
    if out is None:
        out = spark.createDataFrame([], f"{item_col} {parsed.schema['item'].dataType.simpleString()}, rank int, doc_id long, score long")
    return out


def op11_ranked_lexical_search(spark, sf_dir: str) -> DataFrame:
    index = build_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP11_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
n AS (SELECT *, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
g AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM n),
p AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM n) GROUP BY ALL),
f AS (SELECT term, floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, g GROUP BY term),
q AS (SELECT item_id, term, count(*)::BIGINT AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM (SELECT item_id, min(text) AS text FROM benchmark GROUP BY item_id)) GROUP BY ALL),
s AS (
  SELECT q.item_id, n.r, n.doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words))))::BIGINT AS score
  FROM q JOIN p ON q.term = p.term JOIN f ON q.term = f.term JOIN n ON p.r = n.r, g GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)::INT AS rank FROM s WHERE score > 0) WHERE rank <= 10"""
