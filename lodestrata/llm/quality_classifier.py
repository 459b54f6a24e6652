"""Operator 10: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, bound_batches, by_bytes, flat, mix, words

HASH_BITS, RANK = 15, 8
SAMPLE_ROWS = 6000  # bound on the labelled rows that the model is fitted on
SIGNS = [b"!", b"$%&#*@^~", b"|", b".,;:", b"<>{}[]()=+_/\\", b"\"'`-?"]
STATS = 19


def _class_masks() -> np.ndarray:
    out = np.zeros((11, 256), np.float32)
    for k, chars in enumerate(SIGNS):
        out[k, list(chars)] = 1
    out[6, 65:91] = 1
    out[7, 97:123] = 1
    out[8, 48:58] = 1
    out[9] = SPACE
    out[10, 128:] = 1
    return out


MASKS = _class_masks()


def features(data: np.ndarray, off: np.ndarray, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse word features (row, bucket, value) and dense statistics (rows x STATS) of each row's whole text."""
    rows = len(off) - 1
    codes, s, e, first = words(data, off)
    row = np.repeat(np.arange(rows), np.diff(first))
    key, times = np.unique((row.astype(np.int64) << HASH_BITS) | (mix(codes) >> np.uint64(64 - HASH_BITS)).astype(np.int64), return_counts=True)
    owner, bucket = key >> HASH_BITS, key & ((1 << HASH_BITS) - 1)
    value = 1 + np.log(times)
    norm = np.sqrt(np.bincount(owner, value * value, rows))
    value = value / np.maximum(norm[owner], 1e-9)
    size = np.diff(off)
    stat = np.zeros((rows, STATS))
    held = np.flatnonzero(size)
    again = (codes[1:] == codes[:-1]) & (row[1:] == row[:-1])  # a word straight after itself
    if len(held):
        for k in range(len(MASKS)):
            stat[held, k] = np.add.reduceat(MASKS[k][data], off[:-1][held]) / size[held]
    n_words = np.diff(first)
    length = (e - s).astype(np.float64)
    total = np.bincount(row, length, rows)
    mean = total / np.maximum(n_words, 1)
    stat[:, 11] = mean
    stat[:, 12] = np.sqrt(np.maximum(np.bincount(row, length * length, rows) / np.maximum(n_words, 1) - mean**2, 0))
    stat[:, 13] = np.bincount(owner, minlength=rows) / np.maximum(n_words, 1)
    stat[:, 14] = np.log1p(n_words)
    stat[:, 15] = np.log1p(np.maximum(n_chars, 0))
    stat[:, 16] = np.bincount(row, length > 14, rows) / np.maximum(n_words, 1)
    if len(held):
        stat[held, 17] = np.add.reduceat((data == 10).astype(np.float64), off[:-1][held]) / np.maximum(n_words[held], 1)
    stat[:, 18] = np.bincount(row[1:], again, rows) / np.maximum(n_words, 1) if len(row) else 0
    return owner, bucket, value, stat


class Machine:
    """score = sigmoid(w0 + <w, x> + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)): linear in the non-zeros."""

    def __init__(self, seed: int = 3):
        rng = np.random.Generator(np.random.PCG64(seed))
        d = (1 << HASH_BITS) + STATS
        self.w0, self.w, self.v = 0.0, np.zeros(d), rng.normal(0, 0.05, (d, RANK))
        self.mean, self.scale = np.zeros(STATS), np.ones(STATS)

    def rows(self, owner, bucket, value, stat):
        n = len(stat)
        z = np.clip((stat - self.mean) / self.scale, -4, 4) * 0.5
        row = np.r_[owner, np.repeat(np.arange(n), STATS)]
        col = np.r_[bucket, np.tile(np.arange(STATS) + (1 << HASH_BITS), n)]
        return row, col, np.r_[value, z.ravel()], n

    def margin(self, row, col, x, n):
        total = self.w0 + np.bincount(row, self.w[col] * x, n)
        sums = np.empty((n, RANK))
        for f in range(RANK):
            vx = self.v[col, f] * x
            sums[:, f] = np.bincount(row, vx, n)
            total += 0.5 * (sums[:, f] ** 2 - np.bincount(row, vx * vx, n))
        return total, sums

    def score(self, owner, bucket, value, stat):
        return 1 / (1 + np.exp(-np.clip(self.margin(*self.rows(owner, bucket, value, stat))[0], -35, 35)))

    def fit(self, docs: list[tuple], labels: np.ndarray, epochs: int = 12, batch: int = 128, rate: float = 0.08, ridge: float = 1e-4, seed: int = 4) -> Machine:
        """AdaGrad on the logistic loss. docs: (bucket, value, stat) of each row."""
        if not len(labels):
            return self
        stats = np.stack([s for _, _, s in docs])
        self.mean, self.scale = stats.mean(axis=0), stats.std(axis=0) + 1e-6
        rate_of = min(max(labels.mean(), 0.01), 0.99)
        self.w0 = float(np.log(rate_of / (1 - rate_of)))
        gw, gv, g0 = np.full_like(self.w, 1e-3), np.full_like(self.v, 1e-3), 1e-3
        rng = np.random.Generator(np.random.PCG64(seed))
        for _ in range(epochs):
            order = rng.permutation(len(labels))
            for at in range(0, len(order), batch):
                pick = order[at : at + batch]
                own = np.repeat(np.arange(len(pick)), [len(docs[i][0]) for i in pick])
                row, col, x, n = self.rows(own, np.concatenate([docs[i][0] for i in pick]), np.concatenate([docs[i][1] for i in pick]), stats[pick])
                margin, sums = self.margin(row, col, x, n)
                err = (1 / (1 + np.exp(-np.clip(margin, -35, 35))) - labels[pick]) / n
                cols, code = np.unique(col, return_inverse=True)
                ex = err[row] * x
                grad = np.bincount(code, ex, len(cols)) + ridge * self.w[cols]
                gw[cols] += grad * grad
                self.w[cols] -= rate * grad / np.sqrt(gw[cols])
                for f in range(RANK):
                    grad = np.bincount(code, ex * (sums[row, f] - self.v[col, f] * x), len(cols)) + ridge * self.v[cols, f]
                    gv[cols, f] += grad * grad
                    self.v[cols, f] -= 0.5 * rate * grad / np.sqrt(gv[cols, f])
                g0 += err.sum() ** 2
                self.w0 -= rate * err.sum() / np.sqrt(g0)
        return self


def held_out(id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(chars, F.length(F.col(text_col)), F.lit(0)).cast("long").alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on at most ``sample_rows`` labelled ids outside the held-out fifth, taken in order of a hash of the id. Documents of
    one id count as one, that with the smallest statistics, so the driver gets no more rows than that."""
    bound_batches(docs.sparkSession)
    picked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", F.col("quality").cast("double").alias("quality")).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)

    def extract(batches):
        for b in by_bytes(batches, "text"):
            owner, bucket, value, stat = features(*flat(b.column("text")), b.column("n_chars").to_numpy(zero_copy_only=False))
            cuts = np.searchsorted(owner, np.arange(b.num_rows + 1))
            spans = list(zip(cuts[:-1], cuts[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("quality"), pa.array([bucket[i:j].astype(np.int32).tobytes() for i, j in spans], pa.binary()), pa.array([value[i:j].astype(np.float32).tobytes() for i, j in spans], pa.binary()), pa.array([s.tobytes() for s in stat], pa.binary())],
                ["doc_id", "quality", "bucket", "value", "stat"],
            )

    got = _rows(docs, id_col, text_col).join(F.broadcast(picked), "doc_id").select("doc_id", "text", "n_chars", "quality")
    got = got.mapInArrow(extract, "doc_id long, quality double, bucket binary, value binary, stat binary").groupBy("doc_id").agg(F.min(F.struct("stat", "bucket", "value", "quality")).alias("r"))
    got = sorted(got.select("doc_id", "r.*").collect(), key=lambda r: r.doc_id)
    return Machine().fit([(np.frombuffer(r.bucket, np.int32), np.frombuffer(r.value, np.float32).astype(float), np.frombuffer(r.stat)) for r in got], np.array([r.quality for r in got]))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: float = 0.3, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """A row for every row of docs: id, held_out, score (0 to 1), predicted (1 if score >= cut).

    Null and empty texts are scored on their statistics alone; a null n_chars is the text's length; null ids are never
    held out. Repeated rows are scored each. Without usable labels every score is 0.5. Labels, language, source and id are
    no inputs. Other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, sample_rows))

    def run(batches):
        for b in by_bytes(batches, "text"):
            p = model.value.score(*features(*flat(b.column("text")), b.column("n_chars").to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    out = _rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, score double")
    return out.select(F.col("doc_id").alias(id_col), F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", cut: float = 0.3, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of docs, all columns, whose score is at least ``cut``; scored in place, without a join."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, sample_rows))
    names = docs.columns

    def run(batches):
        for b in by_bytes(batches, text_col):
            data, off = flat(b.column(text_col))
            text = b.column(text_col)
            chars = pc.fill_null(pc.utf8_length(text), 0)
            if "n_chars" in names:
                chars = pc.coalesce(pc.cast(b.column("n_chars"), pa.int64()), pc.cast(chars, pa.int64()))
            p = model.value.score(*features(data, off, chars.to_numpy(zero_copy_only=False)))
            yield b.filter(pa.array(p >= cut))

    return docs.mapInArrow(run, docs.schema)


def op10_quality_classifier(spark, sf_dir: str) -> DataFrame:
    return score_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
