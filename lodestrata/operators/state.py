"""State machines over run histories as running aggregates: health, cadence, checkpoints, pagination yield, eligibility."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import store as to_shared
from .scan import lagged, large_keys, numbered, running, since

# Fixed values.
SUSPEND_AFTER = 3
TO_WEEKLY, TO_MONTHLY = 7, 4
DAYS = {"DAILY": 1, "WEEKLY": 7, "MONTHLY": 30}
TRANSITIONS = {"PENDING": ["RUNNING", "SKIPPED_STATUS"], "RUNNING": ["SUCCEEDED", "FAILED"], "FAILED": ["RUNNING"]}
STATES = ["PENDING", "RUNNING", "SUCCEEDED", "FAILED", "SKIPPED_STATUS"]


def health(runs: DataFrame, key: str = "source_id", order: tuple[str, ...] = ("ts", "run_id"), large: list | None = None) -> DataFrame:
    """G09. failures (consecutive) and health after each run: ACTIVE, WARNING, SUSPENDED from the third failure on. A source with
    most of the runs is scanned in ranges (see ``scan``)."""
    failed = F.col("status") == "FAILED"
    out = since(runs, [key], list(order), failed, ~failed, "failures", large=large)
    return out.withColumn("health", F.when(F.col("failures") == 0, "ACTIVE").when(F.col("failures") < SUSPEND_AFTER, "WARNING").otherwise("SUSPENDED"))


def cadence(runs: DataFrame, key: str = "source_id", order: tuple[str, ...] = ("ts", "run_id"), base: str = "DAILY", large: list | None = None) -> DataFrame:
    """G10 and D01. Cadence after each run and the next due time. A change resets to the base; unchanged runs count;
    failures count neither way. From a daily base the 7th unchanged run makes WEEKLY and, as the count goes on, the 8th
    MONTHLY; from a weekly base the 4th makes MONTHLY."""
    out = since(runs, [key], list(order), F.col("status") == "NO_CHANGE", F.col("status") == "CHANGED", "unchanged", large=large)
    n = F.col("unchanged")
    after = {
        "DAILY": F.when(n >= TO_WEEKLY + 1, "MONTHLY").when(n >= TO_WEEKLY, "WEEKLY").otherwise("DAILY"),
        "WEEKLY": F.when(n >= TO_MONTHLY, "MONTHLY").otherwise("WEEKLY"),
        "MONTHLY": F.lit("MONTHLY"),
    }[base]
    days = F.lit(DAYS["MONTHLY"])
    for name, d in DAYS.items():
        days = F.when(F.col("cadence") == name, F.lit(d)).otherwise(days)
    return out.withColumn("cadence", after).withColumn("next_eligible_at", F.col("ts") + F.make_dt_interval(days))


def eligibility(sources: DataFrame, now: Column, force: bool = False) -> DataFrame:
    """F50. eligible and reason for rows of (health, next_eligible_at), null for a new source."""
    reason = F.when(F.lit(force), "FORCED").when(F.col("health").isNull(), "NEW").when(F.col("health") == "SUSPENDED", "SUSPENDED").when(F.col("next_eligible_at") > now, "NOT_DUE").otherwise("DUE")
    return sources.withColumn("reason", reason).withColumn("eligible", ~F.col("reason").isin("SUSPENDED", "NOT_DUE"))


def after_run(runs: DataFrame) -> DataFrame:
    """G11. Health, cadence and next due time after each run; a failure retries in four hours unless it suspends."""
    large = large_keys(runs, ["source_id"])
    h = health(runs, large=large).select("source_id", "run_id", "failures", "health")
    out = cadence(runs, large=large).join(h, ["source_id", "run_id"])
    retry = F.when(F.col("health") != "SUSPENDED", F.col("ts") + F.expr("INTERVAL 4 HOURS"))
    return out.withColumn("next_eligible_at", F.when(F.col("status") == "FAILED", retry).otherwise(F.col("next_eligible_at")))


def pagination_yield(pages: DataFrame, family: str, order: list[str], new: str, least: int = 2, empty: int = 2, window: int = 3) -> DataFrame:
    """W08. Per page: page number, trailing empty pages, recent yield, and whether the family has stopped (for good) by
    then. A stopped family is not observed further, so its later pages repeat the state."""
    p = pages.withColumns({"__new": F.greatest(F.lit(0), F.col(new)), "__one": F.lit(1).cast("long")})
    large = large_keys(p, [family])
    store = to_shared if large else lambda df: df
    out = store(since(p, [family], order, F.col("__new") == 0, F.col("__new") != 0, "empty_streak", large=large))
    out = store(running(out, [family], order, {"page_no": ("sum", "__one"), "__sum": ("sum", "__new")}, large=large))
    out = lagged(out, [family], order, "__sum", "__earlier", window, large=large).withColumn("recent", F.col("__sum") - F.coalesce("__earlier", F.lit(0)))
    stop = (F.col("page_no") >= least) & (F.col("empty_streak") >= empty) & (F.col("recent") == 0)
    out = running(store(out.withColumn("__stop", stop.cast("int"))), [family], order, {"__stopped": ("max", "__stop")}, large=large)
    return out.withColumn("stopped", F.col("__stopped") > 0).withColumn("page_no", F.col("page_no").cast("int")).drop("__new", "__one", "__sum", "__earlier", "__stop", "__stopped")


def checkpoint_check(events: DataFrame, key: str, order: list[str], state: str) -> DataFrame:
    """G12. Each event with the state before it and whether the step is allowed; the first state must be PENDING."""
    out = lagged(events, [key], order, state, "previous")
    ok = F.col("previous").isNull() & (F.col(state) == "PENDING")
    for a, b in TRANSITIONS.items():
        ok = ok | (F.coalesce(F.col("previous") == a, F.lit(False)) & F.col(state).isin(*b))
    return out.withColumn("allowed", F.coalesce(ok, F.lit(False)))


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """S14, S15, S17, Z20. The last row of each key under a total order."""
    return df.groupBy(*key).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("__r")).select("__r.*")


def recover(checkpoint: DataFrame) -> DataFrame:
    """G13. Interrupted runs have failed."""
    return checkpoint.withColumn("state", F.when(F.col("state") == "RUNNING", "FAILED").otherwise(F.col("state")))


def resumable(checkpoint: DataFrame, include_failed: bool = True) -> DataFrame:
    """F69."""
    return checkpoint.where(F.col("state").isin("PENDING", *(["FAILED"] if include_failed else [])))


def run_pass(checkpoint: DataFrame, outcomes: DataFrame, run: str = "run_id", order: str = "ord", most: int | None = None, fail_fast: bool = False, include_failed: bool = True) -> DataFrame:
    """G15. The checkpoint after one pass of the run loop: of each run's sources, in order, the interrupted count as failed, the
    resumable ones are run, at most ``most`` and with ``fail_fast`` none after the first that fails. ``outcomes``: (run,
    source_id, ok); a source without one fails. Returns the checkpoint with its new states and attempts."""
    c = recover(checkpoint).join(outcomes.select(run, "source_id", "ok"), [run, "source_id"], "left")
    due = F.col("state").isin("PENDING", *(["FAILED"] if include_failed else []))
    failed = ~F.coalesce("ok", F.lit(False))
    upto = Window.partitionBy(run).orderBy(order)
    c = c.withColumn("__due", due)
    c = c.withColumns({"__n": F.sum(F.col("__due").cast("int")).over(upto), "__f": F.coalesce(F.sum((F.col("__due") & failed).cast("int")).over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    go = F.col("__due") & (F.lit(True) if most is None else F.col("__n") <= most) & ((F.col("__f") == 0) | F.lit(not fail_fast))
    state = F.when(go, F.when(failed, "FAILED").otherwise("SUCCEEDED")).otherwise(F.col("state"))
    return c.withColumns({"state": state, "attempts": F.col("attempts") + go.cast("int")}).drop("ok", "__due", "__n", "__f")


def state_summary(checkpoint: DataFrame) -> DataFrame:
    """A23. Count of each known state, zero included."""
    known = checkpoint.sparkSession.createDataFrame([(s,) for s in STATES], "state string")
    counts = checkpoint.groupBy("state").agg(F.count("*").alias("n"))
    return known.join(counts, "state", "left").select("state", F.coalesce("n", F.lit(0)).alias("n"))


def within_budget(requests: DataFrame, key: str, order: list[str], budget: int) -> DataFrame:
    """G18. The first ``budget`` requests of each key."""
    return numbered(requests, [key], order, "request_no").withColumn("request_no", F.col("request_no").cast("int")).where(F.col("request_no") <= budget)


def backoff(attempt: Column, base: float = 1.0) -> Column:
    """D05, without jitter."""
    return F.lit(base) * F.pow(F.lit(2.0), attempt - 1)


def retry_after(value: Column, now: Column, most: int = 120) -> Column:
    """D06. Seconds from a Retry-After header: a number, null if it is negative, or an HTTP date (0 if it is past); capped; null if neither."""
    seconds = F.trim(value).try_cast("double")
    date = F.try_to_timestamp(F.substring(F.trim(value), 6, 100), F.lit("dd MMM yyyy HH:mm:ss z"))
    wait = F.when(seconds.isNotNull(), F.when(seconds >= 0, seconds)).when(date.isNotNull(), F.greatest(F.lit(0.0), (F.unix_micros(date) - F.unix_micros(now)) / 1e6))
    return F.when(wait.isNotNull(), F.least(wait, F.lit(float(most))))
