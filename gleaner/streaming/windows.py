"""Streaming dedupe and rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.payloads import WRITE_OK


def stream_dedupe(stream: DataFrame, keys: Sequence[str], lookback: str = "3 days", time: str = "published") -> DataFrame:
    """Each item once within the lookback; items behind the watermark are dropped by the state store."""
    return stream.withWatermark(time, lookback).dropDuplicatesWithinWatermark(list(keys))


def drop_late(stream: DataFrame, lookback_days: int, now: Column, time: str = "published") -> DataFrame:
    """The batch lookback rule on a stream, so that both forms keep the same rows."""
    return stream.where(F.col(time) >= now - F.make_dt_interval(F.lit(lookback_days)))


def window_counts(stream: DataFrame, labels: Sequence[str], window: str, delay: str = "1 hour", time: str = "ts") -> DataFrame:
    """Tumbling counts by label."""
    return (
        stream.withWatermark(time, delay).groupBy(F.window(time, window).alias("w"), *labels)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), *labels, "n")
    )


def failing_write_counts(stream: DataFrame, window: str = "15 minutes", delay: str = "1 hour") -> DataFrame:
    return window_counts(stream.where(~F.col("status").isin(*WRITE_OK)), ["status"], window, delay)


def abandoned_stream(starts: DataFrame, finished: DataFrame, deadline: str = "6 hours") -> DataFrame:
    """Starts that got no finished row within the deadline: an outer stream-stream join bounded by watermarks."""
    s = starts.withWatermark("started_at", "10 minutes").alias("s")
    f = finished.select(F.col("run_id").alias("done_id"), "completed_at").withWatermark("completed_at", "10 minutes").alias("f")
    in_time = F.expr(
        f"run_id = done_id AND completed_at >= started_at AND completed_at <= started_at + INTERVAL {deadline}")
    return s.join(f, in_time, "left_outer").where(F.col("done_id").isNull()).select(
        "run_id", "profile", "started_at", F.lit("abandoned").alias("status"))
