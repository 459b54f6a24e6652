"""Streaming cadence of sources: the batch rule of unchanged runs as state, and timers that tell when a source is due."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..operators.state import DAYS, TO_MONTHLY, TO_WEEKLY

OUT = "source_id long, run_id long, kind string, unchanged long, cadence string, next_eligible_at timestamp"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000


def cadence_of(unchanged: int) -> str:
    """G10, from a daily base."""
    return "MONTHLY" if unchanged >= TO_WEEKLY + 1 else "WEEKLY" if unchanged >= TO_WEEKLY else "DAILY"


class Cadence(StatefulProcessor):
    """State of a source: unchanged runs since the last change, its last run's time and the time it is due. A run sets a timer at
    the due time, which tells that the source is DUE, and one ``keep_days`` later, which forgets a source that has not run since."""

    def __init__(self, keep_days: int = 365):
        self.keep_days = keep_days

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("cadence", "unchanged long, run_id long, due_ms long")

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        import pandas as pd

        unchanged, _, due = self.state.get() if self.state.exists() else (0, None, None)
        if due is not None:
            for at in (due, due + self.keep_days * DAY_MS):
                self.handle.deleteTimer(at)
        pdf = pd.concat(list(rows)).sort_values(["ts", "run_id"])
        out = []
        for run, status, ts in zip(pdf["run_id"], pdf["status"], pdf["ts"], strict=True):
            unchanged = 0 if status == "CHANGED" else unchanged + 1 if status == "NO_CHANGE" else unchanged
            after = cadence_of(unchanged)
            due_at = ts + pd.Timedelta(days=DAYS[after])
            out.append((key[0], run, "RUN", unchanged, after, due_at))
        due = int(due_at.timestamp() * 1000)
        self.state.update((int(unchanged), int(run), due))
        for at in (due, due + self.keep_days * DAY_MS):
            self.handle.registerTimer(at)
        yield pd.DataFrame(out, columns=[f.split()[0] for f in OUT.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        import pandas as pd

        if not self.state.exists():
            return
        unchanged, run, due = self.state.get()
        if expiredTimerInfo.getExpiryTimeInMs() > due:
            self.state.clear()
            return
        yield pd.DataFrame([(key[0], run, "DUE", unchanged, cadence_of(unchanged), pd.Timestamp(due, unit="ms"))], columns=[f.split()[0] for f in OUT.split(", ")])

    def close(self) -> None:
        pass


def streaming_cadence(runs: DataFrame, late: str = "1 day", keep_days: int = 365) -> DataFrame:
    """A stream of (source_id, ts, run_id, status) to one of RUN rows, one for each run with the cadence after it, and DUE rows, when the
    watermark passes a source's due time before its next run. Rows older than the watermark are ignored. Needs the RocksDB
    state store, see ``run_available``."""
    return runs.withWatermark("ts", late).groupBy("source_id").transformWithStateInPandas(statefulProcessor=Cadence(keep_days), outputStructType=OUT, outputMode="Append", timeMode="EventTime")


def run_available(spark: SparkSession, runs: DataFrame, checkpoint: str, out: str, **options) -> None:
    """Process what is available of a stream of runs, then stop; a restart goes on from the checkpoint, and a batch that is run again
    replaces its output. The state store is set for this query only."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKS)
    try:

        def save(batch: DataFrame, n: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch={n}")

        streaming_cadence(runs, **options).writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def event_runs(spark: SparkSession, path: str) -> DataFrame:
    """A stream of runs from a folder of event files, or from one file."""
    schema = spark.read.parquet(path).schema
    place, reader = spark._jvm.org.apache.hadoop.fs.Path(path), spark.readStream.schema(schema)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():
        reader, path = reader.option("pathGlobFilter", place.getName()), str(place.getParent())
    status = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type").isin("purchase", "signup"), "CHANGED").otherwise("NO_CHANGE")
    return reader.parquet(path).select(F.col("user_id").alias("source_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("run_id"), status.alias("status"))
