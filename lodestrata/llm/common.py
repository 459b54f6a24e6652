"""Shared pieces: tables in the cluster's shared folder, text batches, vectorised hashing, components."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240817))
BYTE_CODES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
BASE = U(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = U(pow(int(BASE), -1, 2**64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


BATCH_BYTES = 4 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Let no Arrow batch that Spark hands to Python exceed BATCH_BYTES (but for a single longer row), whatever a row weighs."""
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(ARROW_BYTES)) > BATCH_BYTES:
        spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Where that is unset, a folder of this machine serves a
    session that runs on this machine alone (tests); on a cluster it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return (base or "/tmp/checkpoints").rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/lodestrata-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote, once all that reads them is written, and let Spark drop the shuffle files of
    queries that are done (it does so when the driver's garbage is collected)."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        spark._jvm.System.gc()


def plan_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the input's bytes, from file sizes; sets partition counts only, never results."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def part_count(df: DataFrame, mb: float = 2.5, least: int = 64, most: int = 1 << 20) -> int:
    return max(least, min(most, int(plan_bytes(df) / (mb * 1e6)) + 1))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column laid end to end, and the row offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    off = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)), off - off[0]


def give_back() -> None:
    """Return freed memory to the system, where the C library can: a worker that waits for its next task holds none."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def by_bytes(batches: Iterable[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` bytes of text; a longer text gets a slice of its own and is never cut."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, side="right")))
            yield batch.slice(at, end - at)
            at = end
        give_back()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", BASE), ("down", BASE_INVERSE)):
            seq = np.full(size, base, np.uint64)
            seq[0] = 1
            _powers[name] = np.multiply.accumulate(seq)
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(29))) * U(0xA3B195354A39B70D)
    return x ^ (x >> U(32))


def prefix_codes(data: np.ndarray) -> np.ndarray:
    """Running sums whose differences identify substrings: a polynomial over random byte codes modulo 2^64."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * powers(len(data))[0], out=out[1:])
    return out


def span_codes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit codes of the byte ranges [start, end)."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix))[1][start] + (end - start).astype(np.uint64) * U(0xC2B2AE3D27D4EB4F))


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs without ASCII white space; A-Z count as a-z): codes, starts, ends, and each row's first word (rows + 1)."""
    solid = ~SPACE[data]
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    inner = off[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    start[inner] = solid[inner]
    end[inner - 1] = solid[inner - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return span_codes(prefix_codes(LOWER[data]), s, e), s, e, np.searchsorted(s, off)


def pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length as compressed bytes, byte planes apart so that slow-changing bytes vanish."""
    import zstandard

    n = len(columns[0])
    head = np.array([n, len(columns), *[c.dtype.itemsize for c in columns]], np.int64).tobytes()
    body = b"".join(np.ascontiguousarray(np.ascontiguousarray(c).view(np.uint8).reshape(n, -1).T).tobytes() for c in columns) if n else b""
    return head + zstandard.ZstdCompressor(level=1).compress(body)


def unpack(blob: bytes, types: list) -> list[np.ndarray]:
    import zstandard

    n, k = np.frombuffer(blob, np.int64, 2)
    sizes = np.frombuffer(blob, np.int64, k, 16)
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[16 + 8 * int(k) :]), np.uint8) if n else np.zeros(0, np.uint8)
    out, at = [], 0
    for size, kind in zip(sizes, types, strict=True):
        out.append(np.ascontiguousarray(body[at : at + n * size].reshape(size, n).T).reshape(-1).view(kind) if n else np.zeros(0, kind))
        at += n * size
    return out


def unpack_all(blobs, types: list) -> list[np.ndarray]:
    parts = [unpack(b.as_py() if hasattr(b, "as_py") else b, types) for b in blobs]
    return [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, types[i]) for i in range(len(types))]


def deal(bucket: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
    """One packed blob for each bucket that has rows."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for run in np.split(order, cuts) if len(order) else []:
        yield int(bucket[run[0]]), pack(*[c[run] for c in columns])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the edges (a, b), by vectorised min-hooking."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        lo, hi = np.minimum(ra, rb), np.maximum(ra, rb)
        live = lo != hi
        if not live.any():
            break
        a, b = a[live], b[live]
        np.minimum.at(root, hi[live], lo[live])
        while (deeper := root[root] != root).any():
            root = np.where(deeper, root[root], root)
    return root


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components (node, root = smallest reachable id) of a table of links, by alternating large-star and
    small-star steps: each step is an aggregation and a join, and is written to the shared folder. Nodes without a link
    to another node are absent. Nulls and self-links are ignored."""
    edges = materialize(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    )
    seen = None
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).union(least.select("u", "m")).distinct()
        edges = materialize(small)
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo") % 1000003), F.sum("lo")).first())
        if state == seen:
            break
        seen = state
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(edges.select(F.col("lo"), F.col("lo")).distinct())
