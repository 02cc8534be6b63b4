"""Catalogue: streaming operators run to the end of the given tables; each equals its batch twin."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from gleaner.plans.note_queries import UPSERT_SQL, incoming_and_stored
from gleaner.plans.registry import query
from gleaner.operators import reports
from gleaner.plans.run_queries import STALLS, WRITES_SQL
from gleaner.plans.views import Tables, attempts_of, probes_of, runs_of, with_views
from gleaner.session import checkpoint_dir
from gleaner.streaming import keyed, upserts, windows


#: parts of the events, oldest first, each arriving after the stream has run over those before it
ARRIVALS = 3


def _folder(t: Tables, name: str) -> str:
    return f"{checkpoint_dir(t.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _in_arrivals(t: Tables, root: str, start: Callable[[DataFrame], DataStreamWriter]) -> None:
    """Run a stream over the events as they arrive: in time order, in several runs that go on where the last one ended.

    Each part is written to a shared folder and the stream is started again over what is new, so state is carried from
    batch to batch and across restarts.
    """
    events = t.events
    at = events.select(F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("at"))
    cuts = sorted(set(at.approxQuantile("at", [i / ARRIVALS for i in range(1, ARRIVALS)], 0.01)))
    number = F.lit(0)
    for cut in cuts:
        number = number + (F.unix_micros(F.col("ts").cast("timestamp")) > F.lit(int(cut))).cast("int")
    for part in range(len(cuts) + 1):
        events.where(number == part).write.mode("append").parquet(f"{root}/in")
        stream = t.spark.readStream.schema(events.schema).parquet(f"{root}/in").withColumn(
            "ts", F.col("ts").cast("timestamp"))
        start(stream).option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start().awaitTermination()


@query("select distinct user_id, event_type, strftime(ts, '%Y-%m-%d') as day from events")
def stream_dedupe(t: Tables) -> DataFrame:
    root = _folder(t, "dedupe")

    def start(events: DataFrame) -> DataStreamWriter:
        keyed = events.select("user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"), "ts")
        once = windows.stream_dedupe(keyed, ["user_id", "event_type", "day"], "3 days", "ts")
        return once.writeStream.format("parquet").option("path", f"{root}/out")

    _in_arrivals(t, root, start)
    return t.spark.read.parquet(f"{root}/out").select("user_id", "event_type", "day")


@query(f"""with {WRITES_SQL} select strftime(time_bucket(interval '15 minutes', ts), '%Y-%m-%d %H:%M:%S') as window_start, status, count(*) as n
from w where status not in ('created', 'updated') group by 1, 2""")
def stream_rates(t: Tables) -> DataFrame:
    root = _folder(t, "rates")
    status = F.expr("case event_type when 'error' then 'slug_collision' when 'click' then 'version_conflict' "
                    "when 'view' then 'created' else 'updated' end").alias("status")

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    # update mode gives every change of a count; the newest batch of each window holds its value
    _in_arrivals(t, root, lambda events: windows.failing_write_counts(events.select("ts", status)).writeStream.outputMode(
        "update").foreachBatch(step))
    changes = t.spark.read.parquet(f"{root}/out")
    return changes.groupBy("window_start", "status").agg(F.max_by("n", "batch").alias("n")).select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "status", "n")


def _rows_of(t: Tables, name: str, of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a stream over the arriving events appends, run to its end."""
    root = _folder(t, name)
    _in_arrivals(t, root, lambda events: of(events).writeStream.format("parquet").option("path", f"{root}/out"))
    return t.spark.read.parquet(f"{root}/out")


@query(with_views("runs_v", body=STALLS + "select run_id, ingestion_stall, fetch_stall from f"))
def stream_stalls(t: Tables) -> DataFrame:
    found = _rows_of(t, "stalls", lambda events: keyed.stalls(runs_of(events)))
    return found.select("run_id", "ingestion_stall", "fetch_stall")


@query(with_views("attempts_v", body="""+
c as (select *, case when failure_stage in ('parse', 'validate', 'oversize') then 1 else 0 end as counted from attempts_v),
n as (select *, sum(counted) over (partition by note_id, stage order by ts, attempt_id) as n_counted from c)
select attempt_id, cast(n_counted as bigint) as n_counted, n_counted >= 3 as terminal, counted = 1 and n_counted = 3 as flips
from n"""))
def stream_attempts(t: Tables) -> DataFrame:
    found = _rows_of(t, "attempts", lambda events: keyed.attempts(attempts_of(events)))
    return found.select("attempt_id", "n_counted", "terminal", "flips")


@query(with_views("probes_v", body="""+
g as (
  select *, sum(case when status <> 'degraded' then 1 else 0 end) over (partition by target order by ts, probe_id) as grp
  from probes_v)
select probe_id, count(*) filter (where status = 'degraded') over (partition by target, grp order by ts, probe_id) as bad_streak,
  count(*) filter (where status = 'degraded') over (partition by target, grp order by ts, probe_id) >= 3 as circuit_open
from g"""))
def stream_circuit(t: Tables) -> DataFrame:
    found = _rows_of(t, "circuit", lambda events: keyed.breaker(probes_of(events)))
    return found.select("probe_id", "bad_streak", "circuit_open")


@query(with_views("runs_v", body="""+
d as (select *, row_number() over (partition by profile order by completed_at, run_id) - 1 as run_no from runs_v
  where status = 'completed'),
w as (select *, run_no // 7 as window_id, count(*) over (partition by profile, run_no // 7) as n from d),
g as (select distinct w.profile, window_id, run_id, t.tag from w, unnest([kind, 'checked:' || sources_checked]) as t(tag)
  where n = 7 and t.tag is not null)
select profile, cast(window_id as bigint) as window_id, tag, count(*) as total,
  count(*) filter (where run_id % 4 = 0) as n_rejected, round(count(*) filter (where run_id % 4 = 0) / count(*), 4) as rate
from g group by profile, window_id, tag"""))
def stream_cadence(t: Tables) -> DataFrame:
    tags = F.array_compact(F.array(F.col("kind"), F.concat(F.lit("checked:"), F.col("sources_checked").cast("string"))))
    items = _rows_of(t, "cadence", lambda events: keyed.closed_windows(
        runs_of(events), 7, tags, F.col("run_id") % 4 == 0))
    return reports.rejection_rates(items, ["profile", "window_id"])


@query("""
with s as (select event_id // 2 as run_id, cast(user_id as varchar) as profile, ts as started_at from events
  where event_id % 2 = 0 and event_type <> 'error'),
f as (select event_id // 2 as run_id, ts as completed_at from events where event_id % 2 = 1 and event_type <> 'click'),
m as (select greatest((select max(started_at) from s), (select max(completed_at) from f)) - interval '10 minutes' as mark)
select s.run_id, s.profile, 'abandoned' as status from s, m where s.started_at + interval '1 day' <= mark and not exists (
  select 1 from f where f.run_id = s.run_id and f.completed_at between s.started_at and s.started_at + interval '1 day')""")
def stream_abandoned(t: Tables) -> DataFrame:
    def of(events: DataFrame) -> DataFrame:
        rows = events.select((F.col("event_id") / 2).cast("long").alias("run_id"), F.col("user_id").alias("profile"),
                             F.col("ts").alias("started_at"), F.col("ts").alias("completed_at"), "event_type",
                             (F.col("event_id") % 2 == 0).alias("starts"))
        return keyed.abandoned(rows.where("starts and event_type <> 'error'"),
                               rows.where("not starts and event_type <> 'click'"), timedelta(days=1))

    return _rows_of(t, "abandoned", of).select("run_id", "profile", "status")


@query(f"""with {UPSERT_SQL},
c as (select n, count(*) as c, string_agg(profile || '=' || score, '|' order by profile desc) as newest from i group by n)
select case when known then 's' || n else left(sha256('https://d.example.com/p/' || n), 32) end as note_id,
  case when known then 'Stored ' || n || ' [x]' when held then 'Title ' || n || ' [d.example.com]' else 'Title ' || n end
    as title,
  case when known then 'kept-' || n when held then 'title-' || n || '-d-example-com' else 'title-' || n end as slug,
  case when known then 4 + c else c end as version, case when known then newest || '|old=4' else newest end as relevance,
  greatest(best, case when known then 4 else 0 end) / 10.0 as confidence, md5(text) as full_text_md5 from g join c using (n)
union all select 'r' || n, 'Title ' || n, 'title-' || n, 1, '', 0.1, md5('old' || (select min(text) from i where i.n = g.n))
  from g where held""")
def stream_upsert(t: Tables) -> DataFrame:
    """Three arrivals into a stored table, folded after the second: each write of a note raises its version by one."""
    root = _folder(t, "upsert")
    stored, rows = incoming_and_stored(t)
    upserts.seed(stored, f"{root}/table")
    number = F.col("item_id").cast("long")
    part = F.when(F.col("profile") == "a", 0).otherwise(1 + (number / 2).cast("long") % 2)
    step = upserts.upsert_step(f"{root}/table", fold_every=2)
    for n in range(3):
        rows.where(part == n).write.mode("append").parquet(f"{root}/in")
        stream = t.spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{root}/cp").trigger(
            availableNow=True).start().awaitTermination()
    shown = F.array_join(F.transform("relevance", lambda e: F.concat(
        e["profile"], F.lit("="), e["score"].cast("string"))), "|")
    return upserts.read_store(t.spark, f"{root}/table").select(
        "note_id", "title", "slug", "version", F.coalesce(shown, F.lit("")).alias("relevance"), "confidence",
        F.md5("full_text").alias("full_text_md5"))
