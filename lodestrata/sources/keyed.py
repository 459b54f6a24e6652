"""A table of latest rows by key, kept as versions: an upsert touches only the buckets of its keys, and its version appears at once.

A bucket is a list of pieces, oldest first; an upsert adds one to each bucket that it touches. Buckets whose list grows long are
rewritten as one piece. A version is a small document that lists the pieces of every bucket; readers see the last one."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


REMEMBERED = 10_000  # ids of the last batches that a version's document lists


class VersionConflict(RuntimeError):
    """Another writer has made the next version."""


class KeyedTable:
    """K02, K04, Z17, Z20. Rows by ``key``; of rows with one key the greatest by ``order`` counts, of equal ones the last written.

    Upserts are atomic (a version's document is written aside and moved to its name, which must not exist: a second writer
    of the same version tries again on top of the first) and idempotent (an id of the last 10,000 batches is not applied again;
    rows written twice win over themselves). Moving must be atomic: true for HDFS and local folders, not for all object stores.
    Null keys are a key. ``schema`` is that of the rows; other columns of a batch are dropped, missing ones an error."""

    def __init__(self, spark: SparkSession, path: str, key: list[str], order: list[str], schema: str, buckets: int = 64, pieces: int = 4):
        self.spark, self.path, self.key, self.order, self.schema, self.buckets, self.pieces = spark, path.rstrip("/"), key, order, schema, buckets, pieces
        jvm = spark._jvm
        self.at = lambda p: jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p}")
        self.fs = self.at("x").getFileSystem(spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The last version; 0 before the first upsert."""
        if not self.fs.exists(self.at("versions")):
            return 0
        names = [s.getPath().getName() for s in self.fs.listStatus(self.at("versions"))]
        return max([int(n.removesuffix(".json")) for n in names if n.endswith(".json")], default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "buckets": {}, "batches": []}
        stream = self.fs.open(self.at(f"versions/{version:010d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _swap(self, manifest: dict) -> None:
        tmp, target = self.at(f"versions/.{uuid.uuid4().hex}"), self.at(f"versions/{manifest['version']:010d}.json")
        out = self.fs.create(tmp, False)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(tmp.toUri() if tmp.toUri().getScheme() else self.fs.getUri(), self.spark._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self.fs.makeQualified(tmp), self.fs.makeQualified(target), none)  # fails if the target is there
        except Exception as e:
            self.fs.delete(tmp, False)
            if self.fs.exists(target):
                raise VersionConflict(manifest["version"]) from e
            raise

    def _write(self, rows: DataFrame) -> str:
        piece = uuid.uuid4().hex
        rows.repartition("__bucket").write.option("compression", "zstd").partitionBy("__bucket").parquet(f"{self.path}/pieces/{piece}")
        return piece

    def _latest(self, rows: DataFrame) -> DataFrame:
        columns = [c for c in rows.columns if c not in ("__bucket", "__age")]
        best = F.max_by(F.struct(*columns, "__bucket"), F.struct(*self.order, "__age"))
        return rows.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.key)]).agg(best.alias("r")).select("r.*")

    def _pieces(self, buckets: dict[str, list[str]]) -> DataFrame:
        """All rows of the buckets' pieces; __age tells later ones."""
        age: dict[str, tuple[int, list[str]]] = {}
        for b, pieces in buckets.items():
            for i, p in enumerate(pieces):
                age.setdefault(p, (i, []))[1].append(b)
                age[p] = (max(age[p][0], i), age[p][1])
        out = self.spark.createDataFrame([], f"{self.schema}, __bucket int, __age int")
        names = [c for c in out.columns if c not in ("__bucket", "__age")]
        for p, (_, held) in age.items():
            paths = [f"{self.path}/pieces/{p}/__bucket={b}" for b in held]
            rows = self.spark.read.option("basePath", f"{self.path}/pieces/{p}").schema(f"{self.schema}, __bucket int").parquet(*paths)
            place = F.create_map(*[F.lit(x) for b in held for x in (int(b), buckets[b].index(p))])
            out = out.union(rows.select(*names, "__bucket", place[F.col("__bucket")].alias("__age")))
        return out

    def upsert(self, batch: DataFrame, batch_id: str | None = None, tries: int = 10) -> dict:
        """Apply a batch; returns the version's document. Only touched buckets get a piece; those with too many are rewritten."""
        names = self.spark.createDataFrame([], self.schema).columns
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        if batch_id is not None and batch_id in (m := self.manifest())["batches"]:
            return m
        piece = self._write(self._latest(batch.select(*names).withColumn("__bucket", bucket).withColumn("__age", F.lit(0))))
        root = self.at(f"pieces/{piece}")
        touched = [s.getPath().getName().removeprefix("__bucket=") for s in self.fs.listStatus(root) if s.isDirectory()]
        for _ in range(tries):
            m = self.manifest()
            if batch_id is not None and batch_id in m["batches"]:
                return m
            new = {"version": m["version"] + 1, "buckets": {**m["buckets"]}, "batches": [*m["batches"], *([batch_id] if batch_id is not None else [])][-REMEMBERED:]}
            for b in touched:
                new["buckets"][b] = [*m["buckets"].get(b, []), piece]
            long = {b: p for b, p in new["buckets"].items() if len(p) > self.pieces}
            if long:
                merged = self._write(self._latest(self._pieces(long)))
                for b in long:
                    new["buckets"][b] = [merged]
            try:
                self._swap(new)
                return new
            except VersionConflict:
                continue
        raise VersionConflict(f"gave up after {tries} tries")

    def read(self, version: int | None = None) -> DataFrame:
        """The latest row of each key, as of a version."""
        return self._latest(self._pieces(self.manifest(version)["buckets"])).drop("__bucket")

    def vacuum(self, keep: int = 2) -> int:
        """Delete all but the last ``keep`` versions and the pieces that only they hold; returns the number of pieces deleted. Not to be
        run while an upsert is under way."""
        last = self.version()
        for v in range(1, last - keep + 1):
            self.fs.delete(self.at(f"versions/{v:010d}.json"), False)
        held = {p for v in range(max(1, last - keep + 1), last + 1) for pieces in self.manifest(v)["buckets"].values() for p in pieces}
        dead = [s.getPath() for s in self.fs.listStatus(self.at("pieces")) if s.getPath().getName() not in held] if self.fs.exists(self.at("pieces")) else []
        for p in dead:
            self.fs.delete(p, True)
        return len(dead)
