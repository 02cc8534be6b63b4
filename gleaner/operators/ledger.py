"""Run ledger: stalls, streaks, recent rows, breaker, outcomes, abandoned runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.operators.ordered import CHUNK, HALO, numbered, streaks, with_lookback
from gleaner.vocabulary import LEDGER_WINDOW

RECENT_MIN, RECENT_MAX = 1, 100


def stall_flags(runs: DataFrame, time: str = "completed_at") -> DataFrame:
    """Add `ingestion_stall` and `fetch_stall` to every run.

    A completed scheduled run that checked sources and ingested none stalls when the profile's previous scheduled
    run matched as well; one that checked nothing stalls when the previous one did too while some run of any kind
    had fetched.  Only the profile's previous 20 rows, of any kind, are looked at; failed and skipped scheduled runs
    break the streak.
    """
    rows = with_lookback(runs, ["profile"], [time, "run_id"], LEDGER_WINDOW, [F.col(time), F.col("run_id")])
    before = Window.partitionBy("profile", CHUNK).orderBy(time, "run_id").rowsBetween(-LEDGER_WINDOW, -1)
    scheduled = F.col("kind") == "scheduled"
    last = F.last(F.when(scheduled, F.struct("sources_checked", "ingested")), ignorenulls=True).over(before)
    fetched = F.max(F.col("sources_checked") > 0).over(before)
    done = scheduled & (F.col("status") == "completed")
    no_ingest = done & (F.col("sources_checked") > 0) & (F.col("ingested") == 0) & (
        F.col("_prev.sources_checked") > 0) & (F.col("_prev.ingested") == 0)
    no_fetch = done & (F.col("sources_checked") == 0) & (F.col("_prev.sources_checked") == 0) & F.col("_fetched")
    return (
        rows.withColumn("_prev", last).withColumn("_fetched", F.coalesce(fetched, F.lit(False)))
        .where(~F.col(HALO))
        .withColumn("ingestion_stall", F.coalesce(no_ingest, F.lit(False)))
        .withColumn("fetch_stall", F.coalesce(no_fetch, F.lit(False)))
        .select(*runs.columns, "ingestion_stall", "fetch_stall")
    )


def degraded_reasons(source_errors: Column, ingestion_stall: Column, fetch_stall: Column) -> Column:
    """Ordered, without repeats."""
    return F.array_compact(F.array(
        F.when(source_errors, "source_acquisition"),
        F.when(ingestion_stall, "ingestion_stall"),
        F.when(fetch_stall, "fetch_stall"),
    ))


def run_outcome(status: Column, reasons: Column) -> Column:
    return (
        F.when(status == "skipped", "skipped").when(status.isin("failed", "abandoned"), "failure")
        .when(F.size(reasons) > 0, "degraded").otherwise("success")
    )


def recent(runs: DataFrame, limit: int, profile: object = None, time: str = "completed_at") -> DataFrame:
    """Newest rows first; the limit is clamped to 1..100 and applied after the profile filter."""
    limit = min(max(limit, RECENT_MIN), RECENT_MAX)
    if profile is not None:
        runs = runs.where(F.col("profile") == profile)
    return runs.orderBy(F.col(time).desc(), F.col("run_id").desc()).limit(limit)


def recent_per_profile(runs: DataFrame, limit: int, time: str = "completed_at") -> DataFrame:
    """`recent` for all profiles at once; map tasks keep at most `limit` rows per profile."""
    limit = min(max(limit, RECENT_MIN), RECENT_MAX)
    newest = Window.partitionBy("profile").orderBy(F.col(time).desc(), F.col("run_id").desc())
    return runs.withColumn("rn", F.row_number().over(newest)).where(F.col("rn") <= limit)


def tail(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """Last n rows in ledger order; 0 means all."""
    if n > 0:
        df = df.orderBy(*[F.col(c).desc() for c in order]).limit(n)
    return df.orderBy(*order)


def last_by_profile(runs: DataFrame, time: str = "completed_at") -> DataFrame:
    """Newest row per profile among the newest 100 rows overall."""
    top = recent(runs, RECENT_MAX, time=time)
    others = [c for c in runs.columns if c != "profile"]
    return top.groupBy("profile").agg(
        F.max_by(F.struct(*others), F.struct(time, "run_id")).alias("_r")
    ).select("profile", "_r.*")


def active_runs(active: DataFrame) -> DataFrame:
    return active.orderBy(F.col("started_at").desc(), F.col("run_id").desc())


def all_runs(runs: DataFrame, active: DataFrame) -> DataFrame:
    """Finished and active rows, for lookups by id."""
    return runs.unionByName(active, allowMissingColumns=True)


def circuit(probes: DataFrame, threshold: int = 3, time: str = "ts", key: str = "target") -> DataFrame:
    """Consecutive degraded probes and whether the breaker is open after each one."""
    rows = streaks(
        probes, [key], [F.col(time), F.col("probe_id")], F.col("status") == "degraded",
        [F.col(time), F.col("probe_id")], "bad_streak"
    )
    return rows.withColumn("circuit_open", F.col("bad_streak") >= threshold)


def cadence(runs: DataFrame, n: int, time: str = "completed_at") -> DataFrame:
    """Number the completed runs of each profile and close a reporting window at every n-th."""
    done = runs.where(F.col("status") == "completed")
    if n <= 0:
        return done.limit(0).select("*", *[F.lit(None).cast("bigint").alias(c) for c in ("run_no", "window_id")],
                                    F.lit(False).alias("emits"))
    ranked = numbered(done, ["profile"], [F.col(time), F.col("run_id")], [F.col(time), F.col("run_id")], "run_no")
    return ranked.withColumn("window_id", F.floor((F.col("run_no") - 1) / n).cast("bigint")).withColumn(
        "emits", F.col("run_no") % n == 0
    )


def in_closed_window() -> Column:
    """Whether a run of `cadence` belongs to a window that is complete; a window has at most n rows."""
    return F.max("emits").over(Window.partitionBy("profile", "window_id"))


def run_duration(started: Column, completed: Column) -> Column:
    """Seconds between two instants, null where one cannot be read."""
    return (F.unix_micros(completed) - F.unix_micros(started)) / F.lit(1_000_000.0)


def abandoned_runs(starts: DataFrame, finished: DataFrame, now: Column) -> DataFrame:
    """Started runs without a finished row, with the time they have been open."""
    return (
        starts.join(finished.select("run_id"), "run_id", "left_anti")
        .withColumn("status", F.lit("abandoned"))
        .withColumn("duration_seconds", run_duration(F.col("started_at"), now))
    )


def profile_status(profiles: DataFrame, runs: DataFrame, time: str = "completed_at") -> DataFrame:
    """Every profile with its last run; nulls where it never ran."""
    last = runs.groupBy("profile").agg(
        F.max_by(F.struct(F.col(time).alias("at"), "status"), F.struct(time, "run_id")).alias("_r")
    )
    return profiles.join(last, "profile", "left").select(
        *profiles.columns, F.col("_r.at").alias("last_run_at"), F.col("_r.status").alias("last_run_status")
    )


def with_active_run(profiles: DataFrame, active: DataFrame) -> DataFrame:
    """Every profile with its newest active run, if there is one."""
    newest = active.groupBy("profile").agg(
        F.max_by("run_id", F.struct("started_at", "run_id")).alias("active_run_id"))
    return profiles.join(newest, "profile", "left")


def run_logs(runs: DataFrame, logs: DataFrame) -> DataFrame:
    """Log records of the given runs."""
    head = runs.select("run_id", *[c for c in ("profile", "kind", "status") if c in runs.columns])
    return head.join(logs.drop("profile", "kind", "status"), "run_id")


def breaker_now(probes: DataFrame, threshold: int = 3, time: str = "ts", key: str = "target") -> DataFrame:
    """Breaker state per target after its newest probe.

    Only the newest `threshold` probes matter, so no target's history is sorted.
    """
    newest = Window.partitionBy(key).orderBy(F.col(time).desc(), F.col("probe_id").desc())
    last = probes.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= threshold)
    return last.groupBy(key).agg(
        (F.count_if(F.col("status") == "degraded") >= threshold).alias("circuit_open"))


def overall_status(probes: DataFrame, now: Column, interval_seconds: int = 30, latched: bool = False) -> DataFrame:
    """One row: starting before the first probe, degraded if stale, latched or any probe not ok, else ok."""
    last = probes.groupBy("target").agg(
        F.max_by("status", F.struct("ts", "probe_id")).alias("status"), F.max("ts").alias("ts"))
    return last.agg(
        F.count(F.lit(1)).alias("targets"),
        F.count_if(F.col("status") != "ok").alias("not_ok"),
        F.max("ts").alias("last_probe_at"),
    ).withColumn(
        "overall",
        F.when(F.col("targets") == 0, "starting")
        .when(F.lit(latched) | (F.col("not_ok") > 0)
              | (run_duration(F.col("last_probe_at"), now) > 3 * interval_seconds), "degraded")
        .otherwise("ok"),
    )
