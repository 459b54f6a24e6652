"""Operator 8: benchmark decontamination by q-gram lemma filtering over diagonal bands and banded alignment."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, U, bound_batches, by_bytes, flat, powers, prefix_codes

Q = 8
EDITS = 0.1  # edit budget as a share of the item's bytes
BLOCK_BYTES = 8 << 20  # items that are held in memory at once; more of them take further passes
FILTER_BITS = 24
PAIRS = 1 << 19  # matches of q-grams that are counted at once


class Items:
    """Benchmark items of one q: q-gram postings, edit budgets, diagonal bands."""

    def __init__(self, items: list[tuple[int, bytes]], q: int, share: float):
        self.q, self.ids = q, np.array([i for i, _ in items], np.int64)
        self.text = [LOWER[np.frombuffer(t, np.uint8)].tobytes() for _, t in items]
        size = np.array([len(t) for t in self.text], np.int64)
        self.edits = np.array([budget(len(t), share) for t in self.text], np.int64)
        self.need = size - q + 1 - q * self.edits
        self.band = 2 ** np.ceil(np.log2(self.edits + 2)).astype(np.int64)
        codes, item, pos = [], [], []
        for k, t in enumerate(self.text):
            g = grams(np.frombuffer(t, np.uint8), q)
            codes.append(g)
            item.append(np.full(len(g), k))
            pos.append(np.arange(len(g)))
        codes = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        order = np.argsort(codes, kind="stable")
        self.item, self.pos = (np.concatenate(x)[order] if x else np.zeros(0, np.int64) for x in (item, pos))
        self.codes, first = np.unique(codes[order], return_index=True)
        self.first = np.r_[first, len(order)]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.codes >> U(64 - FILTER_BITS)).astype(np.int64)] = True
        self.longest = int(size.max(initial=0))


def budget(size: int, share: float) -> int:
    return int(share * size + 1e-9)


def by_q(items: list[tuple[int, bytes]], q: int, share: float) -> list[Items]:
    """Items by the largest q up to ``q`` for which the lemma holds with their whole budget: size - q + 1 - q * edits > 0."""
    groups: dict[int, list[tuple[int, bytes]]] = {}
    for i, t in items:
        groups.setdefault(min(q, len(t) // (budget(len(t), share) + 1)), []).append((i, t))
    return [Items(group, k, share) for k, group in sorted(groups.items()) if k > 0]


def grams(data: np.ndarray, q: int) -> np.ndarray:
    prefix = prefix_codes(data)
    x = (prefix[q:] - prefix[:-q]) * powers(len(prefix))[1][: len(prefix) - q]
    return (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)


def banded_distance(item: bytes, text: bytes, edits: int, low: int, high: int) -> tuple[int, int, int]:
    """Least edit distance of ``item`` to a substring of ``text`` that starts on a diagonal in [low, high], with its
    bounds; (edits + 1, 0, 0) if above the budget. A row of the matrix covers diagonals low - edits to high + edits."""
    a, b = np.frombuffer(item, np.uint8), np.frombuffer(text, np.uint8)
    low, high = low - edits, high + edits
    width = high - low + 1
    lanes, big = np.arange(width), len(a) + len(b) + 1
    col = lanes + low
    inside = (col >= 0) & (col <= len(b))
    cost = np.where(inside, 0, big).astype(np.int64)
    start = np.clip(col, 0, len(b))
    padded = np.r_[np.zeros(max(0, -low), np.uint8), b, np.zeros(len(a) + width + 1, np.uint8)]
    shift = max(0, -low) + low
    for i in range(1, len(a) + 1):
        col = lanes + low + i
        valid = (col >= 0) & (col <= len(b))
        match = (padded[shift + i - 1 : shift + i - 1 + width] == a[i - 1]) & (col >= 1)
        diag = np.where(match, cost, cost + 1)
        diag[col < 1] = big
        up = np.r_[cost[1:] + 1, big]
        take = up < diag
        new = np.where(take, up, diag)
        begin = np.where(take, np.r_[start[1:], 0], start)
        new[~valid] = big
        run = np.minimum.accumulate(new - lanes)
        source = np.maximum.accumulate(np.where(new - lanes == run, lanes, 0))
        cost, start = np.minimum(run + lanes, big), begin[source]
        cost[~valid] = big
        if cost.min() > edits:
            return edits + 1, 0, 0
    best = int(np.argmin(cost))
    return int(cost[best]), int(start[best]), int(best + low + len(a))


def matches(data: np.ndarray, off: np.ndarray, indexes: list[Items]) -> list[tuple[int, int, int, int, int]]:
    """(row, item, edits, start, end) of the best occurrence of each item within its budget in each row."""
    return [m for items in indexes for m in _matches(data, off, items)]


def _matches(data: np.ndarray, off: np.ndarray, items: Items) -> list[tuple[int, int, int, int, int]]:
    q, n_items = items.q, len(items.ids)
    if len(data) < q or not len(items.codes):
        return []
    text = LOWER[data]
    codes = grams(text, q)
    at = np.flatnonzero(items.filter[(codes >> U(64 - FILTER_BITS)).astype(np.int64)])
    spot = np.searchsorted(items.codes, codes[at])
    exact = items.codes[np.minimum(spot, len(items.codes) - 1)] == codes[at]
    at, spot = at[exact], spot[exact]
    row = np.searchsorted(off, at, side="right") - 1
    whole = at + q <= off[row + 1]
    at, spot, row = at[whole], spot[whole], row[whole]
    times = items.first[spot + 1] - items.first[spot]
    span = (int(np.diff(off).max(initial=0)) + items.longest) // int(items.band.min()) + 1
    # a text of one repeated byte meets each position of such an item at each of its own: count so many pairs at once
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.cumsum(times)
    begin = 0
    while begin < len(at):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PAIRS, side="right")))
        own = times[begin:end]
        place = np.repeat(items.first[spot[begin:end]] - (np.cumsum(own) - own), own) + np.arange(own.sum())
        item = items.item[place]
        diag = np.repeat(at[begin:end] - off[row[begin:end]], own) - items.pos[place] + items.longest  # not negative
        band = items.band[item]
        bin_ = diag // band
        lap = (diag % band < items.edits[item]) & (bin_ > 0)  # a region within the budget may straddle two bands
        key = (np.repeat(row[begin:end], own) * n_items + item) * span
        k, c = np.unique(np.r_[key + bin_, key[lap] + bin_[lap] - 1], return_counts=True)
        keys, inverse = np.unique(np.r_[keys, k], return_inverse=True)
        counts = np.bincount(inverse, np.r_[counts, c], len(keys)).astype(np.int64)
        begin = end
    item = (keys // span) % n_items
    hot = counts >= items.need[item]
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    letters = [np.bincount(np.frombuffer(t, np.uint8), minlength=256) for t in items.text]
    judged: dict[tuple, tuple[int, int, int]] = {}  # repetitive texts show the same region again and again
    for r, k, b in zip((keys // span // n_items)[hot].tolist(), item[hot].tolist(), (keys % span)[hot].tolist(), strict=True):
        known = best.get((r, k))
        if known and known[0] == 0:
            continue  # bands ascend: a later occurrence is no better than an exact one
        m, e, size = len(items.text[k]), int(items.edits[k]), int(items.band[k])
        low = b * size - items.longest
        high = low + size + e
        begin, end = max(0, low - e), min(int(off[r + 1] - off[r]), high + m + e)
        region = text[off[r] + begin : off[r] + end].tobytes()
        where = region.find(items.text[k])
        if where >= 0:
            found = (0, where, where + m)
        elif np.maximum(letters[k] - np.bincount(np.frombuffer(region, np.uint8), minlength=256), 0).sum() > e:
            continue  # too many of the item's letters are missing
        else:
            if len(judged) > 256:
                judged.clear()
            case = (k, region, low - begin, high - begin)
            if case not in judged:
                judged[case] = banded_distance(items.text[k], region, e, low - begin, high - begin)
            found = judged[case]
        if found[0] <= e:
            found = (found[0], found[1] + begin, found[2] + begin)
            if not known or found < known:
                best[r, k] = found
    return [(r, int(items.ids[k]), *f) for (r, k), f in best.items()]


def contaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, share: float = EDITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Occurrences of benchmark items in documents: id, item_id, edits, start, end (bytes of the text), the best of each
    (document, item), the first on ties.

    An item occurs where some substring of the text is within ``share`` of its bytes in edits (A-Z as a-z). Short items
    are found by shorter q-grams, the longest for which the lemma holds with their whole budget, down to single bytes; so a
    benchmark of one letter occurs in all texts that hold it. Empty and null items, and items with a null id, never occur.
    Benchmarks above 8 MB take one pass for each 8 MB. A task counts at most PAIRS matches of q-grams at a time, however
    repetitive text and item are. Null and empty texts have no occurrences. Repeated rows give repeated results; null ids
    stay null; a repeated item_id is its smallest text. An empty table gives no rows. Other columns are ignored.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = None
    for shared in blocks_of(benchmark):

        def run(batches, shared=shared):
            index = by_q(shared.value, q, share)
            for b in by_bytes(batches, "text"):
                ids = b.column("doc_id")
                rows = [(ids[r].as_py(), *rest) for r, *rest in matches(*flat(b.column("text")), index)]
                if rows:
                    cols = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "item_id", "edits", "start", "end"])

        part = texts.mapInArrow(run, "doc_id long, item_id long, edits int, start long, end long")
        out = part if out is None else out.union(part)
    return out.withColumnRenamed("doc_id", id_col)


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, share: float = EDITS, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, in which no benchmark item occurs; judged in place, without a join."""
    for shared in blocks_of(benchmark):

        def run(batches, shared=shared):
            index = by_q(shared.value, q, share)
            for b in by_bytes(batches, text_col):
                clean = np.ones(b.num_rows, bool)
                clean[[r for r, *_ in matches(*flat(b.column(text_col)), index)]] = False
                yield b.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def blocks_of(benchmark: DataFrame) -> list:
    """Broadcasts of the benchmark's items, at most about BLOCK_BYTES each; a repeated item_id counts once."""
    spark = benchmark.sparkSession
    bound_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).where("item_id is not null").groupBy("item_id").agg(F.min("text").alias("text")).where(F.octet_length("text") > 0)
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = int(-(-total // BLOCK_BYTES)) or 1
    out = []
    for k in range(blocks):
        block = sorted((r.item_id, bytes(r.text)) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect())
        out.append(spark.sparkContext.broadcast(block))
    return out


def op8_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
