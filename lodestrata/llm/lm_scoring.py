"""Operator 3: language-model scoring by online logistic mixing of hashed-context bit predictors.

A token is first known or not (an adaptive bit). A known token is coded as a signature of ten bits (a hash of its first and
last bytes), then itself within its signature; an unknown one byte by byte. Each signature bit is predicted from several contexts (none, the previous token, the tokens
two to four back, the document so far); the predictions are mixed in the logistic domain with weights that a gate selects
(depth of the bit, and whether the first context has been seen often). Each document starts from weights fitted over all
training documents and adapts them online, block by block; a final map refines the mixed probability by what was seen
where it was predicted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, U, bound_batches, by_bytes, deal, flat, materialize, mix, pack, part_count, unpack, unpack_all, words
from .suffix_dedup import part_column

BITS = 10
SIZE = 1 << BITS
BLOCK = 64  # tokens after which a document's weights are updated
BACK = 4  # previous tokens that serve as contexts
NEAR_DEPTH = 6  # bits of the signature that the document's own counts predict
INPUTS = 3 + BACK
RATE = 0.004
APM = 49
END = U(0x5EAF00D5EAF00D01)
SHORT, LONG = 12, 14  # bits of the hashed contexts of two and three bytes
TABLES = 2 + (1 << SHORT - 12) + (1 << LONG - 12)  # of 2^20 counts each
CAUTION = 20.0  # tokens that the corpus-wide share of unknown tokens counts as in each document
VOCAB = [np.uint64, np.uint16, np.int64]


class Tokens:
    """Tokens of a batch of texts, each text closed by an end: codes, signatures, rows, first token of each row."""

    def __init__(self, column: pa.Array):
        data, off = flat(column)
        self.data, self.bytes = LOWER[data], np.diff(off)
        codes, self.s, self.e, first = words(data, off)
        rows = len(off) - 1
        row = np.repeat(np.arange(rows), np.diff(first))
        one = self.e - self.s > 1
        get = lambda at, ok: np.where(ok, self.data[np.clip(at, 0, max(len(data) - 1, 0))] if len(data) else 0, 0).astype(np.uint64)
        shape = get(self.s, True) << U(24) | get(self.s + 1, one) << U(16) | get(self.e - 2, one) << U(8) | get(self.e - 1, True)
        self.at = np.arange(len(codes)) + row  # places of the words among the tokens
        n = len(codes) + rows
        self.code, self.sig = np.full(n, END), np.full(n, END_SIG, np.int64)
        self.code[self.at] = codes
        self.sig[self.at] = (mix(shape + U(1)) >> U(64 - BITS)).astype(np.int64)
        self.first = first + np.arange(rows + 1)
        self.row = np.repeat(np.arange(rows), np.diff(self.first))
        self.word = np.full(n, -1)
        self.word[self.at] = np.arange(len(codes))

    def previous(self, back: int) -> np.ndarray:
        """Signature ``back`` tokens before each token; the end's before the text."""
        out = np.full(len(self.sig), END_SIG, np.int64)
        out[back:] = self.sig[:-back] if back else self.sig
        step = np.arange(len(self.sig)) - self.first[self.row]
        out[step < back] = END_SIG
        return out

    def spelling(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the words ``which``: (word number, contexts of two and three bytes, byte) of each byte and of the blank that
        closes the word."""
        s, size = self.s[which], self.e[which] - self.s[which] + 1
        owner = np.repeat(np.arange(len(which)), size)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size)
        at, last = s[owner] + step, step == size[owner] - 1
        pick = lambda i: self.data[np.clip(i, 0, max(len(self.data) - 1, 0))].astype(np.uint64)
        byte = np.where(last, U(32), pick(at))
        one, two, three = (np.where(step >= k, pick(at - k), U(0)) for k in (1, 2, 3))
        near = one << U(8) | two
        short, long = ((mix(c) >> U(64 - bits)).astype(np.int64) for c, bits in ((near, SHORT), (near << U(8) | three, LONG)))
        return owner, short, long, byte.astype(np.int64)


END_SIG = int(mix(np.array([1], np.uint64))[0] >> U(64 - BITS))


def stretch_table(joint: np.ndarray) -> np.ndarray:
    """From counts (contexts x signatures), for each context and tree node the log odds of a 1, in sixteenths, as int8;
    the lowest bit tells whether the node has been seen eight times."""
    out = np.zeros((len(joint), SIZE), np.int8)
    level = joint.astype(np.float64)
    for depth in range(BITS - 1, -1, -1):
        zero, one = level[:, 0::2], level[:, 1::2]
        odds = np.clip(np.rint(16 * np.log((one + 0.4) / (zero + 0.4))), -126, 126).astype(np.int64)
        out[:, 1 << depth : 2 << depth] = (odds & ~1) | ((zero + one) >= 8)
        level = zero + one
    return out


class Model:
    def __init__(self, tables: np.ndarray):
        """tables: counts of signatures by the previous one, by the one before, and of bytes by two and three bytes (each 2^20)."""
        near, far = tables[:2].reshape(2, SIZE, SIZE)
        self.none = stretch_table(near.sum(axis=0, keepdims=True))[0]
        self.near, self.far = stretch_table(near).ravel(), stretch_table(far).ravel()
        short = tables[2 : 2 + (1 << SHORT - 12)].reshape(1 << SHORT, 256).astype(np.float32)
        long = tables[2 + (1 << SHORT - 12) :].reshape(1 << LONG, 256)
        any_ = (short.sum(axis=0) + 0.1) / (short.sum() + 25.6)
        self.short = ((short + 2 * any_) / (short.sum(axis=1, keepdims=True) + 2)).astype(np.float32)
        self.long, self.long_sum = long.astype(np.float32), long.sum(axis=1).astype(np.float32)
        self.weights = np.full((BITS, 2, INPUTS), 0.3, np.float32)
        self.weights[..., -1] = 0
        self.apm: np.ndarray | None = None

    def spell(self, short: np.ndarray, long: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """log10 probability of each byte after two bytes, refined by what followed three."""
        return np.log10((self.long[long, byte] + 3 * self.short[short, byte]) / (self.long_sum[long] + 3))

    def run(self, t: Tokens, count: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability of the signatures of each row (of the tokens that ``count`` marks, all by default), the sum of
        the rows' final weights weighted by tokens, and the counts (depth x bucket x bit) for the final map. Rows advance
        block by block."""
        total = len(t.first) - 1
        rows = np.arange(total)
        out = np.zeros(total)
        size = np.diff(t.first)
        rows = rows[np.argsort(-size[rows], kind="stable")]
        w = np.repeat(self.weights[None], len(rows), axis=0)  # rows x depth x flag x input
        seen = np.zeros((len(rows), 1 << NEAR_DEPTH, 2), np.float32)
        apm_seen = np.zeros((BITS, APM, 2))
        mean = np.zeros(self.weights.shape)
        back = [t.previous(k) * SIZE for k in range(1, BACK + 1)]
        longest, block = int(size[rows].max(initial=0)), 0
        while block < longest:
            live = int(np.searchsorted(-size[rows], -block, side="left"))  # rows longer than ``block``
            start = t.first[rows[:live]] + block
            width = np.minimum(size[rows[:live]] - block, BLOCK)
            slot = np.repeat(np.arange(live), width)
            at = np.repeat(start - (np.cumsum(width) - width), width) + np.arange(len(slot))
            sig, prev = t.sig[at], [b[at] for b in back]
            own = np.log((seen[:live, :, 1] + 0.4) / (seen[:live, :, 0] + 0.4)).ravel().astype(np.float32)
            gain = np.zeros(len(at), np.float32)
            x = np.empty((INPUTS, len(at)), np.float32)
            x[-1] = 0.3
            for depth in range(BITS):
                node = (1 << depth) | (sig >> (BITS - depth))
                bit = ((sig >> (BITS - 1 - depth)) & 1).astype(bool)
                first = self.near[prev[0] + node]
                flag = (first & 1).astype(np.int64)
                x[0] = self.none[node]
                x[1] = first
                for k in range(1, BACK):
                    x[1 + k] = self.far[prev[k] + node]
                x[: 1 + BACK] *= 0.0625
                x[1 + BACK] = own[(slot << NEAR_DEPTH) + node] if depth < NEAR_DEPTH else 0
                gate = slot * 2 + flag
                wd = w[:live, depth].reshape(live * 2, INPUTS)
                m = x[0] * wd[gate, 0]
                for k in range(1, INPUTS):
                    m += x[k] * wd[gate, k]
                np.clip(m, -8, 8, out=m)
                p = 1 / (1 + np.exp(-m))
                bucket = np.rint((m + 8) * 3).astype(np.int64)
                if self.apm is None:
                    apm_seen[depth] += np.bincount(bucket * 2 + bit, minlength=APM * 2).reshape(APM, 2)
                    final = p
                else:
                    final = 0.5 * (p + self.apm[depth][bucket])
                gain += np.log(np.where(bit, final, 1 - final))
                err = (bit - p) * np.float32(RATE)
                for k in range(INPUTS):
                    wd[:, k] += np.bincount(gate, err * x[k], live * 2).astype(np.float32)
                w[:live, depth] = wd.reshape(live, 2, INPUTS)
                if depth < NEAR_DEPTH:
                    seen[:live] += np.bincount(((slot << NEAR_DEPTH) + node) * 2 + bit, minlength=live << (NEAR_DEPTH + 1)).reshape(live, -1, 2)
            out[rows[:live]] += np.bincount(slot, gain if count is None else gain * count[at], live)
            block += BLOCK
        if len(rows):
            mean = np.einsum("r,rdfi->dfi", size[rows].astype(np.float64), w)
        return out / np.log(10), mean, apm_seen


def held_out(id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 1


def _summed(codes: np.ndarray, sigs: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes, sigs, counts = codes[order], sigs[order], counts[order]
    head = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    return [codes[head], sigs[head], np.add.reduceat(counts, head) if len(head) else counts]


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for every row of docs: id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte.

    Learns from all rows that are not held out (null ids are learnt from). Null and empty texts are one end token.
    Repeated rows are learnt from and scored each. With nothing to learn from, all tokens are unknown. An empty table gives
    no rows; other columns are ignored. The vocabulary is dealt over buckets and never in one place; each part of the texts
    asks for the counts of its own distinct tokens. The bit predictors are tables of fixed size.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    parts = part_count(docs)
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    source = source.withColumn("held", F.coalesce(held_out("doc_id"), F.lit(False)))
    bucket_of = lambda codes: ((codes >> U(32)) * U(parts) >> U(32)).astype(np.int32)
    triple = "kind int, key int, blob binary"

    def triples(found) -> pa.RecordBatch:
        found = list(found)
        return pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.binary())], ["kind", "key", "blob"])

    def learn(batches):
        held = [np.zeros(0, k) for k in VOCAB]
        joint = np.zeros((TABLES, SIZE * SIZE), np.int64)
        for b in by_bytes(batches, "text"):
            t = Tokens(b.column("text"))
            codes, at, times = np.unique(t.code, return_index=True, return_counts=True)
            joint[0] += np.bincount(t.previous(1) * SIZE + t.sig, minlength=SIZE * SIZE)
            joint[1] += np.bincount(t.previous(2) * SIZE + t.sig, minlength=SIZE * SIZE)
            which = t.word[at]
            _, short, long, byte = t.spelling(which[which >= 0])
            joint[2 : 2 + (1 << SHORT - 12)] += np.bincount(short * 256 + byte, minlength=256 << SHORT).reshape(-1, SIZE * SIZE)
            joint[2 + (1 << SHORT - 12) :] += np.bincount(long * 256 + byte, minlength=256 << LONG).reshape(-1, SIZE * SIZE)
            held = _summed(*[np.r_[x, y].astype(k) for x, y, k in zip(held, (codes, t.sig[at], times), VOCAB, strict=True)])
        if len(held[0]):
            yield triples((0, k, blob) for k, blob in deal(bucket_of(held[0]), held))
            cells = joint.reshape(TABLES, 64, -1)
            yield triples((1, i * 64 + j, pack(cells[i, j])) for i in range(TABLES) for j in range(64) if cells[i, j].any())

    learnt = materialize(source.where("not held").select("text").mapInArrow(learn, triple))

    def vocabulary(t: pa.Table) -> pa.Table:
        key = t.column("key")[0].as_py()
        return pa.Table.from_batches([triples([(0, key, pack(*_summed(*unpack_all(t.column("blob").to_pylist(), VOCAB))))])])

    def add(t: pa.Table) -> pa.Table:
        total = None
        for blob in t.column("blob").to_pylist():
            (x,) = unpack(blob, [np.int64])
            total = x if total is None else total + x
        return pa.Table.from_batches([triples([(t.column("kind")[0].as_py(), t.column("key")[0].as_py(), pack(total))])])

    vocab = materialize(learnt.where("kind = 0").groupBy("key").applyInArrow(vocabulary, triple))
    spread = learnt.where("kind = 1").withColumn("kind", F.pmod(F.xxhash64("blob"), F.lit(64)).cast("int"))
    joint = np.zeros((TABLES, 64, SIZE * SIZE // 64), np.int64)
    for r in spread.groupBy("kind", "key").applyInArrow(add, triple).withColumn("kind", F.lit(0)).groupBy("key").applyInArrow(add, triple).collect():
        joint[r.key // 64, r.key % 64] = unpack(bytes(r.blob), [np.int64])[0]
    model = Model(joint.reshape(TABLES, -1))

    def by_signature(batches):
        for b in batches:
            _, sig, n = unpack_all(b.column("blob").to_pylist(), VOCAB)
            held = np.unique(sig)
            yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(np.bincount(sig, n, SIZE)[held].astype(np.int64)), pa.array(np.bincount(sig, minlength=SIZE)[held]), pa.array(np.bincount(sig, n == 1, SIZE)[held].astype(np.int64))], ["sig", "n", "v", "once"])

    mass, distinct, once = np.zeros(SIZE), 0, 0
    for r in vocab.mapInArrow(by_signature, "sig int, n long, v long, once long").groupBy("sig").agg(F.sum("n").alias("n"), F.sum("v").alias("v"), F.sum("once").alias("once")).collect():
        mass[r.sig] = r.n
        distinct, once = distinct + r.v, once + r.once
    tokens = int(mass.sum())
    unseen = min(0.99, (once + 0.5) / (tokens + 1.0))  # share of tokens that are new, after Good and Turing

    shared = spark.sparkContext.broadcast(model)

    def tune(batches):
        weights, seen, total = 0.0, 0.0, 0
        for b in by_bytes(batches, "text"):
            t = Tokens(b.column("text"))
            _, w, s = shared.value.run(t)
            weights, seen, total = weights + w, seen + s, total + len(t.code)
        if total:
            v = np.concatenate([[total], weights.ravel(), seen.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(v), dtype=np.int32)), pa.array(v)], ["i", "v"])

    tuned = np.zeros(1 + model.weights.size + BITS * APM * 2)
    for r in source.where("not held").select("text").mapInArrow(tune, "i int, v double").groupBy("i").agg(F.sum(F.round("v", 6)).alias("v")).collect():
        tuned[r.i] = r.v
    if tuned[0]:
        model.weights = (tuned[1 : 1 + model.weights.size] / tuned[0]).reshape(model.weights.shape).astype(np.float32)
    seen = tuned[1 + model.weights.size :].reshape(BITS, APM, 2)
    prior = 1 / (1 + np.exp(8 - np.arange(APM) / 3))
    model.apm = ((seen[..., 1] + 20 * prior) / (seen.sum(axis=-1) + 20)).clip(1e-5, 1 - 1e-5).astype(np.float32)
    final = spark.sparkContext.broadcast(model)

    texts = source.withColumn("part", F.coalesce(part_column(F.col("doc_id"), parts), F.pmod(F.xxhash64("text"), F.lit(parts)).cast("int"))).groupBy("part")

    def ask(t: pa.Table) -> pa.Table:
        part = t.column("part")[0].as_py()
        codes = np.zeros(0, np.uint64)
        for piece in t.to_batches():
            for b in by_bytes([piece], "text"):
                codes = np.unique(np.r_[codes, Tokens(b.column("text")).code])
        return pa.Table.from_batches([triples((part, k, blob) for k, blob in deal(bucket_of(codes), [codes]))])

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        codes, _, n = unpack_all(known.column("blob").to_pylist(), VOCAB)
        found = []
        for part, blob in zip(asked.column("kind").to_pylist(), asked.column("blob").to_pylist(), strict=True):
            (want,) = unpack(blob, [np.uint64])
            at = np.minimum(np.searchsorted(codes, want), max(len(codes) - 1, 0))
            hit = codes[at] == want if len(codes) else np.zeros(len(want), bool)
            found.append((part, 0, pack(want[hit], n[at[hit]] if len(codes) else n)))
        return pa.Table.from_batches([triples(found)])

    replies = texts.applyInArrow(ask, triple).groupBy("key").cogroup(vocab.select(F.col("key").alias("k"), "blob").groupBy("k")).applyInArrow(answer, triple)

    def score(t: pa.Table, known: pa.Table) -> pa.Table:
        codes, n = unpack_all(known.column("blob").to_pylist(), [np.uint64, np.int64])
        order = np.argsort(codes)
        codes, n = codes[order], n[order]
        out = []
        for piece in t.to_batches():
            for b in by_bytes([piece], "text"):
                k = Tokens(b.column("text"))
                at = np.minimum(np.searchsorted(codes, k.code), max(len(codes) - 1, 0))
                count = np.where(codes[at] == k.code, n[at], 0) if len(codes) else np.zeros(len(k.code), np.int64)
                rows = b.num_rows
                base = np.bincount(k.row, np.log10((count + 0.5) / (tokens + 0.5 * (distinct + 1))), rows)
                known = count > 0
                step = np.arange(len(count)) - k.first[k.row]
                before = np.cumsum(~known) - ~known
                before = before - before[k.first[:-1]][k.row]
                fresh = (before + CAUTION * unseen) / (step + CAUTION)
                leaf = np.bincount(k.row, np.log10(np.where(known, 1 - fresh, fresh)), rows)
                leaf += np.bincount(k.row[known], np.log10(count[known] / mass[k.sig[known]]), rows)
                new = np.flatnonzero(~known & (k.word >= 0))
                owner, short, long, byte = k.spelling(k.word[new])
                leaf += np.bincount(k.row[new][owner], final.value.spell(short, long, byte), rows)
                total = final.value.run(k, count=known)[0] + leaf
                size = k.bytes
                out.append(pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("held"), pa.array(np.diff(k.first)), pa.array(np.bincount(k.row, known, rows).astype(np.int64)), pa.array(np.full(rows, tokens)), pa.array(base), pa.array(total), pa.array(size), pa.array(-total * np.log2(10) / np.maximum(size, 1))],
                    _NAMES,
                ))
        return pa.Table.from_batches(out, _SCHEMA) if out else _SCHEMA.empty_table()

    out = texts.cogroup(replies.select(F.col("kind").alias("home"), "blob").groupBy("home")).applyInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long, bits_per_byte double")
    return out.withColumnRenamed("doc_id", id_col)


_NAMES = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes", "bits_per_byte"]
_SCHEMA = pa.schema([(n, pa.bool_() if n == "held_out" else pa.float64() if n in ("base_score", "score", "bits_per_byte") else pa.int64()) for n in _NAMES])


def op3_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return score_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
