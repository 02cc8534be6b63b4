"""Timestamps of feeds and the day ranges of backfills."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_rfc822(text: Column) -> Column:
    """`Tue, 02 Jan 2024 03:04:05 +0000` (weekday optional; GMT, UT or Z also accepted) to a timestamp."""
    body = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", "")
    body = F.regexp_replace(body, r"\s(?:GMT|UTC|UT|Z)$", " +0000")
    return F.coalesce(
        F.try_to_timestamp(body, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(body, F.lit("d MMM yyyy HH:mm Z")),
    )


def parse_iso(text: Column) -> Column:
    return F.try_to_timestamp(text)


def feed_published(published: Column, updated: Column | None = None, now: Column | None = None) -> Column:
    """published, else updated, else now; always read as UTC."""
    options = [parse_iso(published), parse_rfc822(published)]
    if updated is not None:
        options += [parse_iso(updated), parse_rfc822(updated)]
    return F.coalesce(*options, F.current_timestamp() if now is None else now)


def resolve_range(
    today: date, *, days: int | None = None, date_from: date | None = None, date_to: date | None = None
) -> tuple[date, date]:
    """Half-open day range from either a number of days or both ends."""
    explicit = date_from is not None or date_to is not None
    if (days is None) == (not explicit):
        raise ValueError("give either days or a from/to pair")
    if days is not None:
        return today - timedelta(days=days), today
    if date_from is None or date_to is None:
        raise ValueError("both ends of the range are needed")
    return date_from, date_to


def backfill_days(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day of the half-open range."""
    if end <= start:
        return spark.createDataFrame([], "day DATE")
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end - timedelta(days=1)), F.expr("INTERVAL 1 DAY"))).alias("day")
    )


def day_bounds(start: date, end: date) -> tuple[datetime, datetime]:
    return (
        datetime.combine(start, time.min, timezone.utc),
        datetime.combine(end, time.min, timezone.utc),
    )


def range_days(start: Column, end: Column) -> Column:
    return F.greatest(F.datediff(end, start), F.lit(0))


def query_stamps(start: Column, end: Column) -> Column:
    """First and last minute of a day range in the query form YYYYMMDDHHMM; equal when the range is empty."""
    first = F.concat(F.date_format(start, "yyyyMMdd"), F.lit("0000"))
    last = F.concat(F.date_format(F.date_sub(end, 1), "yyyyMMdd"), F.lit("2359"))
    return F.struct(first.alias("first"), F.when(end <= start, first).otherwise(last).alias("last"))


def since_hours(text: str | None) -> str | None:
    """Day units in hours (`7d` is `168h`); everything else as given."""
    body = (text or "").strip().lower()
    if body.endswith("d") and body[:-1].strip().isdigit():
        return f"{int(body[:-1]) * 24}h"
    return text


def since_interval(text: str) -> timedelta:
    """`7d`, `12h`, `30m`, `45s` as a span for a timestamp predicate."""
    units = {"h": 3600, "m": 60, "s": 1}
    body = since_hours(text).strip().lower()
    return timedelta(seconds=int(body[:-1]) * units[body[-1]])
