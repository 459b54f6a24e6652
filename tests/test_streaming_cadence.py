"""The cadence stream against the batch rule, over a restart from its checkpoint, and its timers."""

from pyspark.sql import functions as F

from lodestrata.operators import state
from lodestrata.streaming import cadence

from .conftest import SF


def test_stream_equals_batch_after_a_restart(spark, tmp_path):
    e = spark.read.parquet(f"{SF}/events.parquet").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type")
    middle = e.agg(F.percentile("event_id", 0.5)).first()[0]
    first_part = e.orderBy("ts").limit(e.count() // 2)
    src, place = tmp_path / "in", {k: str(tmp_path / k) for k in ("state", "out")}
    first_part.coalesce(1).write.parquet(str(src))
    cadence.run_available(spark, cadence.event_runs(spark, str(src)), place["state"], place["out"])
    e.join(first_part.select("event_id"), "event_id", "left_anti").coalesce(1).write.mode("append").parquet(str(src))
    cadence.run_available(spark, cadence.event_runs(spark, str(src)), place["state"], place["out"])
    assert middle is not None and spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != cadence.ROCKS
    runs = e.select(F.col("user_id").alias("source_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("run_id"), F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type").isin("purchase", "signup"), "CHANGED").otherwise("NO_CHANGE").alias("status"))
    want = sorted(tuple(r) for r in state.cadence(runs).select("source_id", "run_id", "unchanged", "cadence", "next_eligible_at").collect())
    got = sorted(tuple(r) for r in spark.read.parquet(place["out"]).where("kind = 'RUN'").select("source_id", "run_id", "unchanged", "cadence", "next_eligible_at").collect())
    assert got == want


def test_due(spark, tmp_path):
    """A source that does not run again is due once the watermark passes its time; one that does is not."""
    rows = [(1, "2024-01-01", 1, "purchase"), (2, "2024-01-01", 2, "purchase"), (3, "2024-01-01", 1, "view"), (4, "2024-01-20", 3, "view"), (5, "2024-01-20 12:00:00", 2, "view")]
    src, place = tmp_path / "in", {k: str(tmp_path / k) for k in ("state", "out")}
    for k, some in enumerate((rows[:3], rows[3:])):
        df = spark.createDataFrame(some, "event_id long, t string, user_id long, event_type string").select("event_id", F.to_timestamp_ntz("t").alias("ts"), "user_id", "event_type")
        df.coalesce(1).write.mode("append" if k else "overwrite").parquet(str(src))
        cadence.run_available(spark, cadence.event_runs(spark, str(src)), place["state"], place["out"])
    due = [(r.source_id, str(r.next_eligible_at)) for r in spark.read.parquet(place["out"]).where("kind = 'DUE'").orderBy("source_id").collect()]
    assert due == [(1, "2024-01-02 00:00:00")]
