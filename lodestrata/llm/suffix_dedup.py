"""Operator 5: removal of repeated byte strings by prefix doubling over sampled positions.

Positions are ranked by fingerprint names instead of sorted characters. Naming and sorting every byte position would
shuffle about 16 bytes for each byte of text, so the first round names one position in about 18: the least of each run of
35 hashed 16-byte prefixes, which any two equal 50-byte strings select alike. Ranks are refined at growing lengths:
16 bytes, then 33 (the pairs of adjacent prefixes on either side), then the whole context of the position (50 to 84 bytes),
then exact 50-byte strings; positions whose rank is unique drop out at each step.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U, bound_batches, by_bytes, deal, flat, materialize, mix, pack, part_count, powers, prefix_codes, span_codes, unpack_all

K = 16
RECORDS = [np.uint64, np.uint64, np.uint32, np.uint32, np.int64, np.uint32, np.uint8, np.uint8]
ASKS = [np.int64, np.uint32, np.uint8, np.uint8, np.uint64]
SPANS = [np.int64, np.uint32, np.uint32]
NAME = U((1 << 48) - 1)
PRIME = (1 << 31) - 1
HALF = U((1 << 24) - 1)
HOLD = 1 << 21  # records that a task gathers before it deals them out


def anchors(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Sampled positions: (position, first window, last window, row, prefix codes). Each window of ``length`` bytes inside
    a row belongs to exactly one anchor, chosen by the window's content alone."""
    n, w = len(data), length - K + 1
    none = np.zeros(0, np.int64)
    prefix = prefix_codes(data)
    if n < length:
        return none, none, none, none, prefix
    code = (prefix[K:] - prefix[:-K]) * powers(n + 1)[1][: n + 1 - K]
    key = ((code ^ (code >> U(32))) * U(0xD6E8FEB86659FD93)) & U(0xFFFFFFFF00000000)
    key |= np.arange(len(key), dtype=np.uint64)
    span = 1
    while span * 2 <= w:
        key = np.minimum(key[:-span], key[span:])
        span *= 2
    if span < w:
        key = np.minimum(key[: len(key) - (w - span)], key[w - span :])
    outside = np.zeros(n + 1, np.int8)
    rows = np.flatnonzero(np.diff(off))
    outside[np.maximum(off[rows], off[rows + 1] - length + 1)] += 1
    outside[off[rows + 1]] -= 1
    window = np.flatnonzero(np.cumsum(outside[: n - length + 1], dtype=np.int8) == 0)
    if not len(window):
        return none, none, none, none, prefix
    least = (key[window] & U(0xFFFFFFFF)).astype(np.int64)
    new = np.r_[True, (np.diff(least) != 0) | (np.diff(window) != 1)]
    start = np.flatnonzero(new)
    end = np.r_[start[1:], len(window)] - 1
    return least[start], window[start], window[end], np.searchsorted(off, least[start], side="right") - 1, prefix


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of half-open spans within each document."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order].astype(np.int64), end[order].astype(np.int64)
    fresh = np.r_[True, doc[1:] != doc[:-1]]
    group = np.cumsum(fresh) - 1
    wide = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * wide) - group * wide
    new = fresh | np.r_[True, start[1:] > reach[:-1]]
    first = np.flatnonzero(new)
    return doc[first], start[first].astype(np.uint32), reach[np.r_[first[1:], len(doc)] - 1].astype(np.uint32)


def part_of(doc: np.ndarray, parts: int) -> np.ndarray:
    """Part of each id: a step of the minimal standard generator, which Spark computes alike (``part_column``)."""
    return (doc.astype(np.int64) % PRIME * 48271 % PRIME % parts).astype(np.int32)


def least_in_group(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort order by keys (the last is the document) and, in that order, the least document of each group."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([np.diff(k[order].view(np.int64) if k.dtype == np.uint64 else k[order].astype(np.int64)) != 0 for k in keys[:-1]], axis=0)
    doc = keys[-1][order]
    return order, doc[np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else doc


def repeated_bytes(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove each byte that a ``length``-byte string covers which also starts in a document with a smaller id.

    Returns id, n_bytes, n_removed, n_spans (maximal removed runs) and kept (the remaining bytes). Strings are judged on
    the input; overlaps count; matches never cross documents. Null and empty texts, and texts below ``length`` bytes,
    lose nothing. Rows with a null id lose nothing and take nothing. Rows that repeat an id should repeat its text: they
    are one document and get the same removals. An empty table gives no rows; other columns are ignored.
    """
    parts = part_count(docs)
    bound_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    half = (length - K + 1) // 2

    def sample(batches):
        held: list[tuple] = []

        def flush():
            cols = [np.concatenate(c) for c in zip(*held, strict=True)]
            held.clear()
            h, c, left, right, doc, q, before, after = cols
            order, low = least_in_group(h, c, doc)
            h, c, left, right, doc, q, before, after = (x[order] for x in cols)
            gone = doc > low
            d, s, e = merged(doc[gone], q[gone] - before[gone], q[gone] - after[gone].astype(np.uint32) + np.uint32(length))
            stay = ~gone
            bucket = ((h[stay] >> U(16)) * U(parts) >> U(32)).astype(np.int32)
            for b, blob in deal(bucket, [x[stay] for x in (h, c, left, right, doc, q, before, after)]):
                yield b, 0, blob
            if len(d):
                yield int(bucket[0]) if len(bucket) else 0, 1, pack(d, s, e)

        def rows(dealt):
            if dealt := list(dealt):
                cols = list(zip(*dealt, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary())], ["bucket", "kind", "blob"])

        for b in by_bytes(batches, "text"):
            data, off = flat(b.column("text"))
            q, lo, hi, row, prefix = anchors(data, off, length)
            doc = np.asarray(b.column("doc_id").to_numpy(zero_copy_only=False))[row].astype(np.int64)
            wide_left, wide_right = q - half >= lo, q + K + half <= hi + length
            left = np.where(wide_left, span_codes(prefix, np.maximum(q - half, 0), q + K) & HALF | U(1), U(0)).astype(np.uint32)
            right = np.where(wide_right, span_codes(prefix, q, np.minimum(q + K + half, len(data))) & HALF | U(1), U(0)).astype(np.uint32)
            held.append((span_codes(prefix, q, q + K) & NAME, span_codes(prefix, lo, hi + length) & NAME, left, right, doc, (q - off[row]).astype(np.uint32), (q - lo).astype(np.uint8), (q - hi).astype(np.uint8)))
            if sum(len(x[0]) for x in held) > HOLD:
                yield from rows(flush())
        if held:
            yield from rows(flush())

    def dealt_table(found: list[tuple[int, int, bytes]]) -> pa.Table:
        return pa.table({"part": pa.array([f[0] for f in found], pa.int32()), "kind": pa.array([f[1] for f in found], pa.int32()), "blob": pa.array([f[2] for f in found], pa.binary())})

    def rank(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        blobs = table.column("blob").to_pylist()
        h, c, left, right, doc, q, before, after = unpack_all([x for x, k in zip(blobs, kind, strict=True) if k == 0], RECORDS)
        d, s, e = unpack_all([x for x, k in zip(blobs, kind, strict=True) if k == 1], SPANS)
        order, low = least_in_group(h, c, doc)
        h, c, left, right, doc, q, before, after = (x[order] for x in (h, c, left, right, doc, q, before, after))
        gone = doc > low
        d, s, e = merged(np.r_[d, doc[gone]], np.r_[s, q[gone] - before[gone]].astype(np.int64), np.r_[e, q[gone] - after[gone].astype(np.uint32) + np.uint32(length)].astype(np.int64))
        found = [(b, 0, blob) for b, blob in deal(part_of(d, parts), [d, s, e])]
        open_ = ~gone
        ask = np.zeros(len(h), bool)
        for side in (left, right):  # another context, in another document, agrees on one side
            at = np.flatnonzero(open_ & (side > 0))
            at = at[np.lexsort((c[at], side[at], h[at]))]
            new = np.ones(len(at), bool)
            new[1:] = (h[at][1:] != h[at][:-1]) | (side[at][1:] != side[at][:-1])
            group = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            if len(at):
                last = np.r_[first[1:], len(at)] - 1
                mixed = (c[at][first] != c[at][last]) & (np.minimum.reduceat(doc[at], first) != np.maximum.reduceat(doc[at], first))
                ask[at[mixed[group]]] = True
        found += [(b, 1, blob) for b, blob in deal(part_of(doc[ask], parts), [doc[ask], q[ask], before[ask], after[ask], h[ask]])]
        return dealt_table(found)

    ranked = source.where("doc_id is not null").where(F.octet_length("text") >= length).mapInArrow(sample, "bucket int, kind int, blob binary")
    ranked = materialize(ranked.groupBy("bucket").applyInArrow(rank, "part int, kind int, blob binary"))

    by_part = source.withColumn("part", F.coalesce(part_column(F.col("doc_id"), parts), F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int")))
    wide = 2 * length - K
    reads = [np.int64, np.uint32, np.uint8, np.uint8, np.uint64, f"V{wide}"]

    def fetch(texts: pa.Table, asked: pa.Table) -> pa.Table:
        doc, q, before, after, h = unpack_all(asked.column("blob").to_pylist(), ASKS)
        data, off = flat(texts.column("text"))
        ids = np.asarray(texts.column("doc_id").to_pandas().fillna(-1)).astype(np.int64)
        order = np.argsort(ids, kind="stable")
        row = order[np.minimum(np.searchsorted(ids, doc, sorter=order), len(order) - 1)] if len(ids) else np.zeros(0, np.int64)
        if not len(row):
            return dealt_table([])
        start = off[row] + q - before
        size = before.astype(np.int64) - after + length
        cell = start[:, None] + np.arange(wide)
        context = np.where(np.arange(wide) < size[:, None], data[np.minimum(cell, len(data) - 1)], 0).astype(np.uint8)
        bucket = ((h >> U(16)) * U(parts) >> U(32)).astype(np.int32)
        return dealt_table([(b, 0, blob) for b, blob in deal(bucket, [doc, q, before, after, h, np.ascontiguousarray(context).view(f"V{wide}").ravel()])])

    def settle(table: pa.Table) -> pa.Table:
        doc, q, before, after, _, context = unpack_all(table.column("blob").to_pylist(), reads)
        prefix = prefix_codes(context.view(np.uint8))
        count = before.astype(np.int64) - after + 1
        row = np.repeat(np.arange(len(doc)), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        at = row * wide + step
        code = span_codes(prefix, at, at + length)
        order, low = least_in_group(code, doc[row])
        row, step = row[order], step[order]
        gone = doc[row] > low
        row, step = row[gone], step[gone]
        start = q[row].astype(np.int64) - before[row] + step
        d, s, e = merged(doc[row], start, start + length)
        return dealt_table([(b, 0, blob) for b, blob in deal(part_of(d, parts), [d, s, e])])

    schema = "part int, kind int, blob binary"
    texts = by_part.groupBy("part")
    read = texts.cogroup(ranked.where("kind = 1").groupBy("part")).applyInArrow(fetch, schema)
    spans = ranked.where("kind = 0").union(read.withColumnRenamed("part", "bucket").groupBy("bucket").applyInArrow(settle, schema))

    def cut(table: pa.Table, found: pa.Table) -> pa.Table:
        d, s, e = unpack_all(found.column("blob").to_pylist(), SPANS)
        d, s, e = merged(d, s.astype(np.int64), e.astype(np.int64))
        data, off = flat(table.column("text"))
        rows = table.num_rows
        ids = table.column("doc_id").to_pandas()
        known = ids.notna().to_numpy()
        ids = ids.fillna(0).to_numpy().astype(np.int64)
        first, last = np.searchsorted(d, ids), np.searchsorted(d, ids, side="right")
        count = np.where(known, last - first, 0)
        row = np.repeat(np.arange(rows), count)
        at = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(len(row))
        size = np.diff(off)
        a, b = np.minimum(s[at], size[row]) + off[row], np.minimum(e[at], size[row]) + off[row]
        change = np.zeros(len(data) + 1, np.int32)
        np.add.at(change, a, 1)
        np.add.at(change, b, -1)
        keep = np.cumsum(change[:-1]) == 0
        left = np.r_[0, np.cumsum(keep)]
        cuts = left[off]
        kept = data[keep]
        wide_off = pa.py_buffer(cuts.astype(np.int64).tobytes())
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), rows, [None, wide_off, pa.py_buffer(kept.tobytes())]).cast(pa.binary()) if rows else pa.array([], pa.binary())
        return pa.table({"doc_id": table.column("doc_id"), "n_bytes": pa.array(size), "n_removed": pa.array(size - np.diff(cuts)), "n_spans": pa.array(np.bincount(row[b > a], minlength=rows).astype(np.int64)), "kept": column})

    out = texts.cogroup(spans.groupBy("part")).applyInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumnRenamed("doc_id", id_col)


def part_column(doc, parts: int):
    """``part_of`` as a Spark expression."""
    return F.pmod(F.pmod(F.pmod(doc, F.lit(PRIME)) * 48271, F.lit(PRIME)), F.lit(parts)).cast("int")


def op5_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    out = repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
