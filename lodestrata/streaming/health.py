"""Streaming health of sources: the batch rule of consecutive failures, kept as state for each source."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OUT = "source_id long, run_id long, failures long, health string"


def step(key, frames: Iterator, state):
    """Runs of one source in event order: failures so far and health after each run."""
    import pandas as pd

    failures = state.get[0] if state.exists else 0
    pdf = pd.concat(list(frames)).sort_values(["ts", "run_id"])
    rows = []
    for run, status in zip(pdf["run_id"], pdf["status"], strict=True):
        failures = failures + 1 if status == "FAILED" else 0
        rows.append((key[0], run, failures, "ACTIVE" if failures == 0 else "WARNING" if failures < 3 else "SUSPENDED"))
    state.update((failures,))
    yield pd.DataFrame(rows, columns=["source_id", "run_id", "failures", "health"])


def streaming_health(runs: DataFrame, late: str = "1 day") -> DataFrame:
    """A stream of (source_id, ts, run_id, status) to one of health after each run. Rows older than the watermark are
    ignored. State is one number for each source."""
    return runs.withWatermark("ts", late).groupBy("source_id").applyInPandasWithState(step, OUT, "failures long", "append", "NoTimeout")


def run_available(spark: SparkSession, events_dir: str, checkpoint: str, out: str) -> None:
    """Process what is available of an event folder (or of one file in a folder), then stop; a restart goes on from the
    checkpoint."""
    reader = spark.readStream.schema(spark.read.parquet(events_dir).schema)
    place = spark._jvm.org.apache.hadoop.fs.Path(events_dir)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isFile():
        reader, events_dir = reader.option("pathGlobFilter", place.getName()), str(place.getParent())
    e = reader.parquet(events_dir)
    status = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type").isin("purchase", "signup"), "CHANGED").otherwise("NO_CHANGE")
    runs = e.select(F.col("user_id").alias("source_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("run_id"), status.alias("status"))

    def save(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={n}")  # a batch that is run again replaces itself

    streaming_health(runs).writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def windowed_failures(runs: DataFrame, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Failures and runs by event-time window; works on streams and tables alike."""
    return runs.withWatermark("ts", late).groupBy(F.window("ts", width)).agg(F.count("*").alias("runs"), F.count_if(F.col("status") == "FAILED").alias("failed"))
