"""Catalog operators: snapshots, differences, content hashes, run reports, catalog queries, packages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def evidence_of_content(content_hash: Column, etag: Column, last_modified: Column) -> Column:
    """D09. The strongest evidence of a resource's content, as text; empty without any."""
    some = lambda tag, c: F.when(c != "", F.concat(F.lit(f"{tag}:"), c))
    return F.coalesce(some("sha256", content_hash), some("etag", etag), some("last-modified", last_modified), F.lit(""))


def snapshot_diff(current: DataFrame, previous: DataFrame, keys: tuple[str, ...] = ("source_id", "resource_key"), evidence: str = "evidence") -> DataFrame:
    """J01. change_status of each resource of either snapshot: NEW, MODIFIED, UNCHANGED or REMOVED. One shuffled full
    join on the keys; both sides must be unique on them."""
    c = current.select(*keys, F.col(evidence).alias("__now"), F.lit(True).alias("__c"))
    p = previous.select(*keys, F.col(evidence).alias("__before"), F.lit(True).alias("__p"))
    status = F.when(F.col("__p").isNull(), "NEW").when(F.col("__c").isNull(), "REMOVED").when(F.col("__now").eqNullSafe(F.col("__before")), "UNCHANGED").otherwise("MODIFIED")
    return c.join(p, list(keys), "full").select(*keys, status.alias("change_status"))


def resources_hash(resources: DataFrame, by: list[str], key: str = "resource_key", evidence: str = "evidence") -> DataFrame:
    """A03. Hash of each snapshot's sorted signatures, ``key|evidence`` or the key alone without evidence, and their number.
    A snapshot's signatures meet in one row, as the hash of their whole requires: 100 bytes a resource."""
    sig = F.concat_ws("|", key, F.nullif(F.col(evidence), F.lit("")))
    return resources.groupBy(*by).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(sig)), "|"), 256).alias("resources_hash"), F.count("*").alias("total_resources"))


def content_status(snapshots: DataFrame, key: str, order: str) -> DataFrame:
    """G16. EMPTY_RESULT, CHANGED (also the first) or NO_CHANGE, against the snapshot before."""
    before = F.lag("resources_hash").over(Window.partitionBy(key).orderBy(order))
    status = F.when(F.col("total_resources") == 0, "EMPTY_RESULT").when(before.isNull() | (before != F.col("resources_hash")), "CHANGED").otherwise("NO_CHANGE")
    return snapshots.withColumn("content_status", status)


def previous_snapshot(snapshots: DataFrame, key: str, at: str, columns: list[str]) -> DataFrame:
    """J02. Columns of the snapshot before each one."""
    w = Window.partitionBy(key).orderBy(at)
    return snapshots.withColumns({f"previous_{c}": F.lag(c).over(w) for c in columns})


def run_report(runs: DataFrame, by: list[str]) -> DataFrame:
    """A01, A02. Counters of each run group."""
    n = lambda cond: F.count_if(cond)
    return runs.groupBy(*by).agg(
        F.count("*").alias("processed"), n(F.col("status") == "FAILED").alias("failed"), n(F.col("status") == "CHANGED").alias("changed"), n(F.col("status") == "NO_CHANGE").alias("unchanged"),
        F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"),
    )


def fetch_errors(fetches: DataFrame, by: list[str], error: str = "error") -> DataFrame:
    """A04, A05. Error counters of a fetch log."""
    e = F.upper(F.col(error))
    return fetches.groupBy(*by).agg(
        F.count("*").alias("requests"), F.count_if(e.contains("TIMEOUT")).alias("timeouts"), F.count_if(e.contains("403")).alias("http_403"),
        F.count_if(e.contains("429")).alias("http_429"), F.count_if(e.contains("ROBOTS")).alias("robots_blocked"), F.countDistinct("url").alias("urls"),
    )


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """T02, O04, O06. The first k rows of each key; Spark limits each task's window to k rows before the shuffle."""
    if not 1 <= k <= 100:
        raise ValueError("k must be from 1 to 100")
    if not by:
        return df.orderBy(*order).limit(k)
    return df.withColumn("rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")).where(F.col("rn") <= k)


class Catalog:
    """E07, E08, K11. The catalog's queries over its tables."""

    def __init__(self, resources: DataFrame, sources: DataFrame, observations: DataFrame, reports: DataFrame):
        self._resources, self._sources, self._observations, self._reports = resources, sources, observations, reports

    def resources(self, source_id: str | None = None) -> DataFrame:
        """O01. Resources of each source's latest snapshot."""
        newest = self._resources.groupBy("source_id").agg(F.max("captured_at").alias("captured_at"))
        out = self._resources.join(newest, ["source_id", "captured_at"], "left_semi")
        return out if source_id is None else out.where(F.col("source_id") == source_id)

    def sources(self) -> DataFrame:
        """O02."""
        return self._sources

    def source(self, source_id: str) -> DataFrame:
        """O03. Raises LookupError if there is none."""
        out = self._sources.where(F.col("source_id") == source_id)
        if out.isEmpty():
            raise LookupError(source_id)
        return out

    def runs(self, limit: int = 20) -> DataFrame:
        """O04."""
        return top_k(self._reports, [], [F.col("finished_at").desc(), F.col("run_id")], limit)

    def report(self, run_id: str) -> DataFrame:
        """O05."""
        out = self._reports.where(F.col("run_id") == run_id)
        if out.isEmpty():
            raise LookupError(run_id)
        return out

    def observations(self, source_id: str, limit: int = 20) -> DataFrame:
        """O06."""
        if limit > 50:
            raise ValueError("limit must be at most 50")
        return top_k(self._observations.where(F.col("source_id") == source_id), [], [F.col("observed_at").desc(), F.col("run_id")], limit)


def duplicate_payloads(rows: DataFrame, digest: str, logical: str, physical: str) -> DataFrame:
    """A15, A16. Groups of at least two equal payloads, and whether they share one physical source."""
    g = rows.groupBy(digest).agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list(F.col(logical).cast("string"))), ",").alias("members"), F.countDistinct(physical).alias("physical_sources"))
    return g.where("n >= 2").withColumn("shared_physical", F.col("physical_sources") == 1)


def checksum_audit(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """J19, J20. Full comparison of (path, sha256) tables: MATCH, MISMATCH, MISSING, EXTRA."""
    j = expected.select("path", F.col("sha256").alias("__e")).join(actual.select("path", F.col("sha256").alias("__a")), "path", "full")
    return j.select("path", F.when(F.col("__e").isNull(), "EXTRA").when(F.col("__a").isNull(), "MISSING").when(F.col("__e") == F.col("__a"), "MATCH").otherwise("MISMATCH").alias("outcome"))


def unsafe_path(path: Column) -> Column:
    """F77."""
    return path.rlike(r"^/|(^|/)\.\.(/|$)")


def unique_key(df: DataFrame, key: str) -> DataFrame:
    """J22. Keys that occur more than once."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def differences(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """U03, U04, U05. Keys in one table only: missing (not in b) or extra (not in a)."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.join(y, key, "left_anti").withColumn("side", F.lit("missing")).union(y.join(x, key, "left_anti").withColumn("side", F.lit("extra")))
