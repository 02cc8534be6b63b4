"""Catalogue: run ledger, logs, probes, attempts, metrics."""

from __future__ import annotations

from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.operators import ledger, reports
from gleaner.operators.predicates import filter_logs, filter_runs, notify_sinks
from gleaner.operators.repair import attempts_and_cap, classify_failure
from gleaner.plans import run_plan
from gleaner.plans.registry import ORACLES, query
from gleaner.plans.views import Tables, with_views
from gleaner.functions.tags import source_family
from gleaner.schemas import NOTES

_TS = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


def _stamp(col: str):
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")


STALLS = """+
o as (select *, row_number() over (partition by profile order by completed_at, run_id) as rn from runs_v),
s as (select *, lag(rn) over w as prn, lag(sources_checked) over w as pc, lag(ingested) over w as pi from o where kind = 'scheduled'
  window w as (partition by profile order by completed_at, run_id)),
h as (select run_id, max(case when sources_checked > 0 then 1 else 0 end) over (partition by profile order by completed_at, run_id rows between 20 preceding and 1 preceding) as fetched from o),
f as (select o.run_id, o.profile, o.status, o.kind, o.completed_at,
  coalesce(s.status = 'completed' and s.sources_checked > 0 and s.ingested = 0 and s.pc > 0 and s.pi = 0 and s.rn - s.prn <= 20, false) as ingestion_stall,
  coalesce(s.status = 'completed' and s.sources_checked = 0 and s.pc = 0 and s.rn - s.prn <= 20 and h.fetched = 1, false) as fetch_stall
  from o left join s on o.run_id = s.run_id join h on o.run_id = h.run_id)
"""


@query(with_views("runs_v", body=STALLS + "select run_id, profile from f where ingestion_stall"))
def ingestion_stall(t: Tables) -> DataFrame:
    return ledger.stall_flags(t.runs_v).where("ingestion_stall").select("run_id", "profile")


@query(with_views("runs_v", body=STALLS + "select run_id, profile from f where fetch_stall"))
def fetch_stall(t: Tables) -> DataFrame:
    return ledger.stall_flags(t.runs_v).where("fetch_stall").select("run_id", "profile")


def _outcomes(t: Tables) -> DataFrame:
    reasons = ledger.degraded_reasons(
        (F.col("status") == "completed") & (F.col("run_id") % 6 == 0), F.col("ingestion_stall"), F.col("fetch_stall"))
    return ledger.stall_flags(t.runs_v).withColumn("degraded_reasons", reasons).withColumn(
        "outcome", ledger.run_outcome(F.col("status"), F.col("degraded_reasons")))


@query(with_views("runs_v", body=STALLS + """, r as (select *, concat_ws(',', case when status = 'completed' and run_id % 6 = 0 then 'source_acquisition' end,
  case when ingestion_stall then 'ingestion_stall' end, case when fetch_stall then 'fetch_stall' end) as reasons from f)
select run_id, reasons, case when status = 'skipped' then 'skipped' when status = 'failed' then 'failure' when reasons <> '' then 'degraded' else 'success' end as outcome from r"""))
def run_outcome(t: Tables) -> DataFrame:
    return _outcomes(t).select("run_id", F.array_join("degraded_reasons", ",").alias("reasons"), "outcome")


@query(with_views("runs_v", body="""
select profile, run_id, status from runs_v qualify row_number() over (partition by profile order by completed_at desc, run_id desc) <= 10"""))
def recent_runs(t: Tables) -> DataFrame:
    return ledger.recent_per_profile(t.runs_v, 10).select("profile", "run_id", "status")


@query(with_views("runs_v", body="select run_id, profile, status from runs_v where profile = 8 order by completed_at desc, run_id desc limit 100"))
def recent_of_profile(t: Tables) -> DataFrame:
    return ledger.recent(t.runs_v, 500, 8).select("run_id", "profile", "status")


@query(with_views("runs_v", body="""+
n as (select * from runs_v order by completed_at desc, run_id desc limit 100)
select profile, run_id, status from n qualify row_number() over (partition by profile order by completed_at desc, run_id desc) = 1"""))
def last_by_profile(t: Tables) -> DataFrame:
    return ledger.last_by_profile(t.runs_v).select("profile", "run_id", "status")


@query(with_views("probes_v", body="""+
o as (select *, sum(case when status = 'ok' then 1 else 0 end) over (partition by target order by ts, probe_id) as island from probes_v)
select probe_id, sum(case when status = 'degraded' then 1 else 0 end) over (partition by target, island order by ts, probe_id) as bad_streak,
  sum(case when status = 'degraded' then 1 else 0 end) over (partition by target, island order by ts, probe_id) >= 3 as circuit_open from o"""))
def circuit_breaker(t: Tables) -> DataFrame:
    return ledger.circuit(t.probes_v).select("probe_id", "bad_streak", "circuit_open")


@query(with_views("probes_v", body="""+
l as (select target, status, row_number() over (partition by target order by ts desc, probe_id desc) as rn from probes_v)
select target, count(*) filter (where status = 'degraded') >= 3 as circuit_open from l where rn <= 3 group by target"""))
def breaker_now(t: Tables) -> DataFrame:
    return ledger.breaker_now(t.probes_v)


@query(with_views("probes_v", body="""+
l as (select target, arg_max(status, (ts, probe_id)) as status, max(ts) as ts from probes_v group by target)
select count(*) as targets, count(*) filter (where status <> 'ok') as not_ok,
  case when count(*) = 0 then 'starting' when count(*) filter (where status <> 'ok') > 0
    or date_diff('second', max(ts), timestamp '2024-01-31 00:00:00') > 90 then 'degraded' else 'ok' end as overall from l"""))
def overall_status(t: Tables) -> DataFrame:
    now = F.lit(datetime(2024, 1, 31, tzinfo=timezone.utc))
    return ledger.overall_status(t.probes_v, now).select("targets", "not_ok", "overall")


@query(with_views("attempts_v", body="""+
c as (select *, case when failure_stage in ('parse', 'validate', 'oversize') then 1 else 0 end as counted from attempts_v),
n as (select *, sum(counted) over (partition by note_id, stage order by ts, attempt_id) as n_counted from c)
select attempt_id, case when failure_stage in ('parse', 'validate', 'oversize') then 'counted' else 'transient' end as class,
  cast(n_counted as bigint) as n_counted, n_counted >= 3 as terminal, counted = 1 and n_counted = 3 as flips from n"""))
def attempts_cap(t: Tables) -> DataFrame:
    return attempts_and_cap(t.attempts_v).select(
        "attempt_id", classify_failure(F.col("failure_stage")).alias("class"), "n_counted", "terminal", "flips")


@query(ORACLES["attempts_cap"])
def attempts_cap_cut(t: Tables) -> DataFrame:
    """The same with every key cut that has more than a handful of rows."""
    return attempts_and_cap(t.attempts_v, hot_rows=5).select(
        "attempt_id", classify_failure(F.col("failure_stage")).alias("class"), "n_counted", "terminal", "flips")


def _starts(t: Tables) -> DataFrame:
    return t.events_v.select(
        F.col("event_id").alias("run_id"), F.col("user_id").alias("profile"),
        (F.col("ts") - F.expr("make_dt_interval(0, 0, cast(event_id % 50 as int))")).alias("started_at"))


STARTS_SQL = "starts as (select event_id as run_id, user_id as profile, ts - to_minutes(cast(event_id % 50 as int)) as started_at from events)"


@query(with_views("runs_v", body=f"""+ {STARTS_SQL}
select s.run_id, 'abandoned' as status, cast(epoch_us(timestamp '2024-02-01') - epoch_us(s.started_at) as double) / 1000000.0 as duration_seconds
from starts s anti join (select run_id from runs_v where run_id % 13 <> 0) r on s.run_id = r.run_id"""))
def abandoned(t: Tables) -> DataFrame:
    finished = t.runs_v.where("run_id % 13 <> 0")
    now = F.lit(datetime(2024, 2, 1, tzinfo=timezone.utc))
    return ledger.abandoned_runs(_starts(t), finished, now).select("run_id", "status", "duration_seconds")


@query(with_views("runs_v", body=f"""+ {STARTS_SQL},
l as (select profile, completed_at, status from runs_v qualify row_number() over (partition by profile order by completed_at desc, run_id desc) = 1),
a as (select profile, max_by(run_id, (started_at, run_id)) as active_run_id from starts where run_id % 13 = 0 group by profile)
select c.c_custkey as profile, {_TS.format('l.completed_at')} as last_run_at, l.status as last_run_status, a.active_run_id
from customer c left join l on l.profile = c.c_custkey left join a on a.profile = c.c_custkey"""))
def profile_status(t: Tables) -> DataFrame:
    profiles = t.customer.select(F.col("c_custkey").alias("profile"))
    state = ledger.profile_status(profiles, t.runs_v)
    return ledger.with_active_run(state, _starts(t).where("run_id % 13 = 0")).select(
        "profile", _stamp("last_run_at").alias("last_run_at"), "last_run_status", "active_run_id")


@query(with_views("runs_v", body="""+
c as (select *, unnest(list_filter([case when status = 'failed' then 'failed' end, case when status = 'skipped' then 'skipped' end,
  case when run_id % 6 = 0 or status = 'failed' then 'degraded' end], lambda x: x is not null)) as class from runs_v),
n as (select *, count(*) over (partition by class) as class_total, row_number() over (partition by class order by completed_at desc, run_id desc) as rn from c)
select class, run_id, class_total, rn from n where rn <= 20"""))
def failure_report(t: Tables) -> DataFrame:
    runs = t.runs_v.withColumn("degraded", F.expr("run_id % 6 = 0 or status = 'failed'"))
    return reports.failure_report(runs).select("class", "run_id", "class_total", "rn")


@query(with_views("runs_v", body="select run_id, profile, status from runs_v where profile = 8 and status in ('failed', 'skipped') and run_id % 2 = 0"))
def filter_failed_runs(t: Tables) -> DataFrame:
    runs = t.runs_v.withColumn("degraded", F.col("run_id") % 2 == 0)
    return filter_runs(runs, 8, ["failed", "skipped"], True).select("run_id", "profile", "status")


@query(with_views("runs_v", "logs_v", body="""
select r.run_id, r.status, l.event_id, l.level, l.sweep_stage from (select run_id, status from runs_v where status = 'failed') r
join logs_v l on l.run_id = r.run_id where l.level in ('ERROR', 'WARNING') and l.sweep_stage = 'slug_collision' and contains(l.props, '7')"""))
def run_logs(t: Tables) -> DataFrame:
    logs = filter_logs(
        t.logs_v.withColumn("message", F.col("props")), ["ERROR", "WARNING"], sweep_stage="slug_collision", contains="7")
    failed = filter_runs(t.runs_v, statuses=["failed"])
    return ledger.run_logs(failed, logs).select("run_id", "status", "event_id", "level", "sweep_stage")


@query(with_views("logs_v", body="select level, count(*) as n from logs_v where level in ('WARNING', 'ERROR', 'CRITICAL') group by level"))
def warnings(t: Tables) -> DataFrame:
    return reports.warning_counts(t.logs_v)


@query(with_views("logs_v", body="""
select s.sweep_stage, count(l.event_id) as n from (values ('tier2_terminal_flip'), ('tier3_terminal_flip'), ('archive_terminal_flip')) s(sweep_stage)
left join logs_v l on l.sweep_stage = s.sweep_stage and l.level = 'WARNING' group by s.sweep_stage"""))
def terminal_flips(t: Tables) -> DataFrame:
    return reports.terminal_flips(t.logs_v)


def _squatter_logs(t: Tables) -> DataFrame:
    e = t.events_v
    first = F.concat(F.lit("00000000"), F.lpad((F.col("user_id") % 40).cast("string"), 4, "0"))
    second = F.concat(F.lit("deadbeef"), F.lpad((F.col("event_id") % 25).cast("string"), 4, "0"))
    detail = F.when(F.col("event_id") % 3 == 0, F.concat(
        F.lit("first_existing_id="), first, F.lit("; Slug 'a-"), F.col("event_type"), F.lit("' already in use; retry_existing_id="),
        second, F.lit("; Slug 'b-"), F.col("event_type"), F.lit("' already in use"))).otherwise(F.concat(
            F.lit("existing_id="), first, F.lit("; Slug 'a-"), F.col("event_type"), F.lit("' already in use")))
    return e.select(
        "event_id", _stamp("ts").alias("timestamp"),
        F.when(F.col("event_type") != "view", "WARNING").otherwise("INFO").alias("level"),
        F.when(F.col("event_id") % 2 == 0, "slug_collision").otherwise("other").alias("status"),
        F.lit("write failed").alias("message"), detail.alias("detail"),
        F.concat(F.lit("https://x/"), (F.col("event_id") % 9).cast("string")).alias("source_url"),
        F.when(F.col("event_id") % 5 == 0, "").otherwise(F.col("event_type")).alias("title"))


MENTIONS = f"""
m as (select {_TS.format('ts')} as timestamp, '00000000' || lpad(cast(user_id % 40 as varchar), 4, '0') as doc_id, 'a-' || event_type as slug,
   'https://x/' || (event_id % 9) as source_url, nullif(case when event_id % 5 = 0 then '' else event_type end, '') as title
   from events where event_type <> 'view' and event_id % 2 = 0
 union all select {_TS.format('ts')}, 'deadbeef' || lpad(cast(event_id % 25 as varchar), 4, '0'), 'b-' || event_type, 'https://x/' || (event_id % 9),
   nullif(case when event_id % 5 = 0 then '' else event_type end, '') from events where event_type <> 'view' and event_id % 2 = 0 and event_id % 3 = 0)
"""


@query(f"""with {MENTIONS} select doc_id, count(*) as n, min(timestamp) as first_seen, max(timestamp) as last_seen,
 count(distinct slug) as n_slugs, count(distinct source_url) as n_urls, count(distinct title) as n_titles from m group by doc_id""")
def squatters(t: Tables) -> DataFrame:
    return reports.squatters(reports.squatter_mentions(_squatter_logs(t)))


@query(f"""with {MENTIONS} , v as (select doc_id, timestamp, 'slug' as field, slug as value from m union all
 select doc_id, timestamp, 'source_url', source_url from m union all select doc_id, timestamp, 'title', title from m where title is not null)
select doc_id, field, value, min(timestamp) as first_seen, count(*) as n from v group by doc_id, field, value""")
def squatter_values(t: Tables) -> DataFrame:
    return reports.squatter_values(reports.squatter_mentions(_squatter_logs(t)))


ERRORS_SQL = """e as (select user_id as profile, event_type as source, case event_id % 3 when 0 then 'http' when 1 then 'timeout' else 'parse' end as kind,
  left(props || repeat('x', 400), 300) as detail from events where event_type in ('error', 'click'))"""


@query(f"with {ERRORS_SQL} select profile, source, kind, count(*) as n, min(detail) as detail from e group by profile, source, kind")
def source_errors(t: Tables) -> DataFrame:
    kind = F.expr("case event_id % 3 when 0 then 'http' when 1 then 'timeout' else 'parse' end")
    error = F.struct(F.col("event_type").alias("source"), kind.alias("kind"),
                     F.concat("props", F.repeat(F.lit("x"), 400)).alias("detail"))
    runs = t.events.select(
        F.col("user_id").alias("profile"),
        F.when(F.col("event_type").isin("error", "click"), F.array(error)).alias("source_acquisition_errors"))
    return reports.source_errors(runs)


@query("""select user_id as profile, count(*) as n, round(quantile_cont(value, 0.95), 6) as p95 from events where event_type <> 'error' group by user_id""")
def duration_p95(t: Tables) -> DataFrame:
    runs = t.events.where("event_type <> 'error'").select(F.col("user_id").alias("profile"), "value")
    return reports.exact_quantile(runs, ["profile"], "value", 0.95).select(
        "profile", "n", F.round("quantile", 6).alias("p95"))


@query("""
with b as (select user_id as profile, list_filter([1.0, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0, 600.0, 1800.0, 3600.0], lambda x: x < value) as under from events),
c as (select profile, len(under) as b, count(*) as n from b group by all),
d as (select *, sum(n) over (partition by profile order by b) as cum, sum(n) over (partition by profile) as total from c),
h as (select * from d where cum >= 0.95 * total qualify row_number() over (partition by profile order by b) = 1)
select profile, cast(total as bigint) as n, case when b = 10 then 3600.0 else round([0.0, 1.0, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0, 600.0, 1800.0, 3600.0][b + 1]
 + ([1.0, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0, 600.0, 1800.0, 3600.0, 3600.0][b + 1] - [0.0, 1.0, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0, 600.0, 1800.0, 3600.0][b + 1]) * (0.95 * total - (cum - n)) / n, 4) end as p95 from h""")
def duration_histogram(t: Tables) -> DataFrame:
    runs = t.events.select(F.col("user_id").alias("profile"), "value")
    return reports.histogram_quantile(runs, ["profile"], "value", 0.95).select(
        "profile", "n", F.round("quantile", 4).alias("p95"))


@query(with_views("runs_v", body=STALLS + """, w as (select *,
  case when run_id % 3 = 0 then 'arxiv' when run_id % 3 = 1 then 'rss' else 'unknown' end as source from runs_v)
select 'run_starts' as name, 'kind=' || kind || ',profile=' || profile as labels, cast(count(*) as double) as value from runs_v group by kind, profile
union all select 'runs_skipped', 'profile=' || profile || ',reason=breaker', cast(count(*) as double) from runs_v where status = 'skipped' group by profile
union all select 'run_completions', 'kind=' || kind || ',outcome=' || status || ',profile=' || profile, cast(count(*) as double) from runs_v group by kind, status, profile
union all select 'candidates_fetched', 'profile=' || profile || ',source=' || case when run_id % 3 = 0 then 'arxiv' when run_id % 3 = 1 then 'rss' else 'unknown' end, cast(sum(sources_checked) as double) from runs_v where sources_checked is not null group by all
union all select 'ingestion_stalls', 'profile=' || profile || ',reason=' || case when ingestion_stall then 'ingestion_stall' else 'fetch_stall' end, cast(count(*) as double) from f where ingestion_stall or fetch_stall group by all
union all select 'slug_collision_unresolved', '', cast(count(*) as double) from runs_v where run_id % 9 = 0
union all select 'run_duration', 'kind=' || kind || ',outcome=' || status || ',profile=' || profile, cast(sum(run_id % 100) as double)
  from runs_v where status <> 'skipped' group by kind, status, profile
union all select 'active_runs', 'kind=' || kind || ',profile=' || profile, cast(sum(case when run_id % 13 = 0 then 1 else 0 end) as double)
  from runs_v group by kind, profile
union all select 'articles_filtered', 'decision=drop,profile=' || profile || ',source=' || source, cast(sum(sources_checked - ingested) as double)
  from w where sources_checked is not null group by profile, source
union all select 'articles_inspected', 'profile=' || profile || ',source=' || source, cast(sum(ingested) as double)
  from w where sources_checked is not null group by profile, source
union all select 'cache_hits', 'profile=' || profile || ',source=' || source, cast(count(*) as double) from w where run_id % 4 = 0 group by profile, source
union all select 'store_writes', 'profile=' || profile || ',source=' || source || ',status=created', cast(sum(ingested) as double)
  from w where ingested > 0 group by profile, source
union all select 'repair_candidates', 'kind=' || kind || ',profile=' || profile, cast(count(*) as double) from w where run_id % 5 = 1 group by kind, profile
union all select 'model_validation_failures', 'tier=tier' || (1 + run_id % 3), cast(count(*) as double) from w where run_id % 7 = 2 group by run_id % 3
union all select 'archive_missing', 'profile=' || profile || ',source=' || source, cast(count(*) as double) from w where run_id % 8 = 3 group by profile, source
union all select 'slug_collision_dedup_recovery', '', cast(count(*) as double) from w where run_id % 10 = 4 having count(*) > 0
union all select 'slug_collision_reclaimed', '', cast(count(*) as double) from w where run_id % 11 = 5 having count(*) > 0
union all select 'source_acquisition_errors', 'kind=' || case when run_id % 2 = 0 then 'http' else 'timeout' end || ',source=' || source,
  cast(count(*) as double) from w where status = 'failed' group by all"""))
def metric_counters(t: Tables) -> DataFrame:
    tags = F.expr("case run_id % 3 when 0 then array('x', 'source:arxiv') when 1 then array('source:blog', 'source:arxiv') else array('x') end")
    profile, kind, status = F.col("profile"), F.col("kind"), F.col("status")
    checked, ingested = F.col("sources_checked"), F.col("ingested")
    source = source_family(F.lit(None).cast("string"), tags)
    reason = F.when(F.col("ingestion_stall"), "ingestion_stall").otherwise("fetch_stall")

    def nth(n: int, rest: int) -> Column:
        return F.col("run_id") % n == rest

    metrics = reports.metrics_long(ledger.stall_flags(t.runs_v), [
        reports.reading("run_starts", profile=profile, kind=kind),
        reports.reading("runs_skipped", status == "skipped", profile=profile, reason=F.lit("breaker")),
        reports.reading("run_completions", profile=profile, kind=kind, outcome=status),
        reports.reading("candidates_fetched", checked.isNotNull(), checked, profile=profile, source=source),
        reports.reading("ingestion_stalls", F.col("ingestion_stall") | F.col("fetch_stall"), profile=profile, reason=reason),
        reports.reading("slug_collision_unresolved", nth(9, 0)),
        reports.reading("run_duration", status != "skipped", F.col("run_id") % 100, profile=profile, kind=kind, outcome=status),
        reports.reading("active_runs", None, nth(13, 0).cast("int"), profile=profile, kind=kind),
        reports.reading("articles_filtered", checked.isNotNull(), checked - ingested, profile=profile, source=source,
                        decision=F.lit("drop")),
        reports.reading("articles_inspected", checked.isNotNull(), ingested, profile=profile, source=source),
        reports.reading("cache_hits", nth(4, 0), profile=profile, source=source),
        reports.reading("store_writes", ingested > 0, ingested, profile=profile, source=source, status=F.lit("created")),
        reports.reading("repair_candidates", nth(5, 1), profile=profile, kind=kind),
        reports.reading("model_validation_failures", nth(7, 2),
                        tier=F.concat(F.lit("tier"), (1 + F.col("run_id") % 3).cast("string"))),
        reports.reading("archive_missing", nth(8, 3), profile=profile, source=source),
        reports.reading("slug_collision_dedup_recovery", nth(10, 4)),
        reports.reading("slug_collision_reclaimed", nth(11, 5)),
        reports.reading("source_acquisition_errors", status == "failed", source=source,
                        kind=F.when(nth(2, 0), "http").otherwise("timeout")),
    ])
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return metrics.select("name", shown.alias("labels"), "value")


@query(f"""
with {STARTS_SQL}, s as (select profile, run_id, started_at as ts, 1 as step from starts union all select user_id, event_id, ts, -1 from events)
select profile, run_id, step, cast(sum(step) over (partition by profile order by ts, step, run_id rows between unbounded preceding and current row) as bigint) as active from s""")
def active_runs(t: Tables) -> DataFrame:
    ends = t.runs_v.select("profile", "run_id", "completed_at")
    return reports.active_run_level(_starts(t), ends).select("profile", "run_id", "step", "active")


WRITES_SQL = """w as (select ts, case event_type when 'error' then 'slug_collision' when 'click' then 'version_conflict' when 'view' then 'created' else 'updated' end as status from events)"""


@query(f"""with {WRITES_SQL} select strftime(time_bucket(interval '15 minutes', ts), '%Y-%m-%d %H:%M:%S') as window_start, status, count(*) as n
from w where status not in ('created', 'updated') group by 1, 2""")
def write_rates(t: Tables) -> DataFrame:
    writes = t.events_v.select(
        "ts", F.expr("case event_type when 'error' then 'slug_collision' when 'click' then 'version_conflict' "
                     "when 'view' then 'created' else 'updated' end").alias("status"))
    return reports.failing_write_rate(writes).select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "status", "n")


@query(with_views("runs_v", body=STALLS + """, r as (select *, case when status = 'skipped' then 'skipped' when status = 'failed' then 'failure'
  when ingestion_stall or fetch_stall or (status = 'completed' and run_id % 6 = 0) then 'degraded' else 'success' end as outcome from f)
select strftime(date_trunc('hour', completed_at), '%Y-%m-%d %H:%M:%S') as window_start, profile, outcome, count(*) as n from r group by 1, 2, 3"""))
def completion_rates(t: Tables) -> DataFrame:
    return reports.completion_rate(_outcomes(t)).select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "profile", "outcome", "n")


@query(with_views("runs_v", body="""+
d as (select *, row_number() over (partition by profile order by completed_at, run_id) as run_no from runs_v where status = 'completed'),
w as (select *, (run_no - 1) // 7 as window_id from d),
c as (select profile, window_id from w group by all having count(*) = 7),
g as (select w.profile, w.window_id, w.run_id, w.sources_checked, unnest([w.kind, 'checked:' || w.sources_checked]) as tag from w join c on w.profile = c.profile and w.window_id = c.window_id)
select profile, cast(window_id as bigint) as window_id, tag, count(*) as total, count(*) filter (where run_id % 4 = 0) as n_rejected,
  round(count(*) filter (where run_id % 4 = 0) / count(*), 4) as rate from g group by profile, window_id, tag"""))
def rejection_cadence(t: Tables) -> DataFrame:
    numbered = ledger.cadence(t.runs_v, 7).withColumn("closed", ledger.in_closed_window())
    items = numbered.where("closed").select(
        "profile", "window_id", (F.col("run_id") % 4 == 0).alias("rejected"),
        F.array(F.col("kind"), F.concat(F.lit("checked:"), F.col("sources_checked").cast("string"))).alias("tags"))
    return reports.rejection_rates(items, ["profile", "window_id"])


@query(with_views("runs_v", body="""select run_id, sources_checked - ingested as filtered, ingested from runs_v"""))
def run_stats(t: Tables) -> DataFrame:
    return reports.run_stats(t.runs_v).select("run_id", "filtered", "ingested")


@query("""
with r as (select o_orderkey as run_id, case o_orderkey % 3 when 0 then 'scheduled' when 1 then 'manual' else 'backfill' end as kind from orders),
i as (select l_orderkey as run_id, l_orderkey || '-' || l_linenumber as item_id, cast(1 + (l_partkey % 10) as int) as score from lineitem),
s as (select * from (values ('all-digest', 'digest', null), ('good-digest', 'digest', 9), ('toasts', 'article', 8)) x(sink, mode, min_score)),
b as (select run_id, max(score) as best from i group by run_id)
select r.run_id, r.kind, s.sink, cast(null as varchar) as item_id from r join s on s.mode = 'digest' left join b on b.run_id = r.run_id
 where (r.kind = 'scheduled' or (r.kind = 'manual' and s.sink = 'all-digest')) and (s.min_score is null or coalesce(b.best >= s.min_score, false))
union all select r.run_id, r.kind, s.sink, i.item_id from r join s on s.mode = 'article' join i on i.run_id = r.run_id
 where r.kind = 'scheduled' and i.score >= s.min_score""")
def notify(t: Tables) -> DataFrame:
    runs = t.orders.select(
        F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("profile"),
        F.expr("case o_orderkey % 3 when 0 then 'scheduled' when 1 then 'manual' else 'backfill' end").alias("kind"))
    items = t.lineitem.select(
        F.col("l_orderkey").alias("run_id"), F.expr("concat(l_orderkey, '-', l_linenumber)").alias("item_id"),
        F.expr("cast(1 + (l_partkey % 10) as int)").alias("score"))
    sinks = t.spark.createDataFrame(
        [("all-digest", "digest", "digest", True, ["scheduled", "manual"], None),
         ("good-digest", "digest", "digest", True, ["scheduled"], 9),
         ("toasts", "toast", "article", True, ["scheduled"], 8),
         ("off", "digest", "digest", False, ["scheduled"], None)],
        "name STRING, type STRING, event_mode STRING, enabled BOOLEAN, notify_on ARRAY<STRING>, min_score INT")
    return notify_sinks(sinks, runs, items).select("run_id", "kind", "sink", "item_id")


WHOLE_RUN_SQL = """c as (select lang as profile, case when doc_id % 2 = 0 then 'arxiv' else 'rss' end as source, doc_id,
  1 + doc_id % 10 as score from documents where doc_id % 5 < 3)"""


def _whole_run(t: Tables) -> run_plan.RunResult:
    """One scheduled run over all documents: two fifths are older than the lookback, six in ten score below the gate."""
    documents = t.documents
    profiles = documents.select(F.col("lang").alias("profile")).distinct().select(
        "profile", F.lit("d").alias("description"), F.lit(True).alias("enabled"), F.lit(7).alias("relevance"),
        F.lit(8).alias("full_text"), F.lit(9).alias("deep_extract"), F.lit(8).alias("notify_immediate"),
        F.lit(0.75).alias("edge_score"))
    paper = F.col("doc_id") % 2 == 0
    number = F.col("doc_id").cast("string")
    items = documents.select(
        F.col("lang").alias("profile"), F.when(paper, "arxiv").otherwise("rss").alias("source"), number.alias("item_id"),
        F.concat(F.lit("Title "), number).alias("title"), F.col("text").alias("abstract"),
        F.concat(F.lit("https://example.com/d/"), number).alias("source_url"),
        F.expr("timestamp'2026-01-10 00:00:00' - make_dt_interval(cast(doc_id % 5 as int))").alias("published"),
        F.array(F.lit("cs.AI")).alias("categories"), F.when(paper, "arxiv").otherwise("blog").alias("source_tag"),
        F.when(~paper, "My Feed").alias("feed_name"), F.lit(None).cast("string").alias("html"))

    def scorer(rows: pd.DataFrame) -> pd.DataFrame:
        score = [float(1 + int(i) % 10) for i in rows["item_id"]]
        return pd.DataFrame({"item_id": rows["item_id"], "score": score, "confidence": 0.5, "reason": "r",
                             "filter_tags": [[]] * len(rows)})

    plan = run_plan.RunPlan(now=datetime(2026, 1, 10, 12, tzinfo=timezone.utc))
    stored = t.spark.createDataFrame([], NOTES)
    return run_plan.run(t.spark, plan, profiles, stored, run_plan.Plugs(lambda spark, p: items, scorer),
                        finished=datetime(2026, 1, 10, 12, 1, tzinfo=timezone.utc))


@query(f"""with {WHOLE_RUN_SQL} select 'https://example.com/d/' || doc_id as source_url, 'Title ' || doc_id as title,
  'title-' || doc_id as slug, 1 as version, profile || '=' || score as relevance, score / 10.0 as confidence,
  case when source = 'arxiv' then 'papers/arxiv/2026/01' else 'articles/blog/2026/01' end as path from c where score >= 7""")
def run_notes(t: Tables) -> DataFrame:
    shown = F.transform("relevance", lambda e: F.concat(e["profile"], F.lit("="), e["score"].cast("string")))
    return _whole_run(t).notes.select("source_url", "title", "slug", "version", F.array_join(shown, "|").alias("relevance"),
                                      "confidence", "path")


@query(f"""with {WHOLE_RUN_SQL},
p as (select profile, count(*) as sources_checked, count(*) filter (where score >= 7) as ingested from c group by profile)
select c.profile, c.source, count(*) as fetched, count(*) filter (where score >= 7) as filter_pass,
  count(*) filter (where score < 7) as filter_drop, 0 as cache_hits, count(*) filter (where score >= 7) as created,
  0 as failed, sources_checked, ingested, 60.0::double as duration_seconds, 'success' as outcome
from c join p on p.profile = c.profile group by c.profile, c.source, sources_checked, ingested""")
def run_report(t: Tables) -> DataFrame:
    result = _whole_run(t)
    runs = result.runs.select("profile", "sources_checked", "ingested", "duration_seconds", "outcome")
    return result.funnel.join(runs, "profile").select(
        "profile", "source", "fetched", "filter_pass", "filter_drop", "cache_hits", "created", "failed", "sources_checked",
        "ingested", "duration_seconds", "outcome")
