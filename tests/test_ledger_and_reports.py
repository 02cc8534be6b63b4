from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleaner.operators import ledger, predicates, reports
from gleaner.sources import feeds

START = datetime(2024, 1, 1)


def ledger_rows(spark, rows):
    """(profile, kind, status, checked, ingested) in append order."""
    return spark.createDataFrame(
        [(i, *r, START + timedelta(minutes=i)) for i, r in enumerate(rows)],
        "run_id INT, profile STRING, kind STRING, status STRING, sources_checked INT, ingested INT, completed_at TIMESTAMP")


def flags(spark, rows):
    out = ledger.stall_flags(ledger_rows(spark, rows)).orderBy("run_id").collect()
    return [("I" if r.ingestion_stall else "") + ("F" if r.fetch_stall else "") for r in out]


def run(kind="scheduled", checked=3, ingested=0, profile="p", status="completed"):
    return (profile, kind, status, checked, ingested)


def test_ingestion_stall_needs_two_in_a_row(spark):
    assert flags(spark, [run(), run(), run(ingested=1), run(), run()]) == ["", "I", "", "", "I"]


def test_other_kinds_do_not_break_a_streak_but_failures_do(spark):
    rows = [run(), run("backfill"), run("manual", ingested=2), run(), run(status="failed", checked=None, ingested=None), run()]
    assert flags(spark, rows) == ["", "", "", "I", "", ""]


def test_profiles_are_apart(spark):
    assert flags(spark, [run(), run(profile="q"), run(), run(profile="q", ingested=1)]) == ["", "", "I", ""]


def test_fetch_stall_needs_an_earlier_fetch(spark):
    quiet = [run(checked=0), run(checked=0), run(checked=0)]
    assert flags(spark, quiet) == ["", "", ""]
    assert flags(spark, [run("manual", checked=2, ingested=1), *quiet]) == ["", "", "F", "F"]


def test_only_twenty_rows_are_visible(spark):
    fill = [run("manual", checked=1, ingested=1)]
    assert flags(spark, [run(), *fill * 19, run()])[-1] == "I"
    assert flags(spark, [run(), *fill * 20, run()])[-1] == ""
    zero = [run("manual", checked=0)]
    assert flags(spark, [run("manual", checked=5), *zero * 18, run(checked=0), run(checked=0)])[-1] == "F"
    assert flags(spark, [run("manual", checked=5), *zero * 19, run(checked=0), run(checked=0)])[-1] == ""


def test_outcomes(spark):
    df = spark.createDataFrame([("completed", False, False, False), ("completed", True, True, False), ("failed", True, False, False),
                                ("skipped", False, False, True), ("abandoned", False, False, False)],
                               "status STRING, e BOOLEAN, i BOOLEAN, f BOOLEAN")
    reasons = ledger.degraded_reasons(F.col("e"), F.col("i"), F.col("f"))
    got = df.select(reasons.alias("r"), ledger.run_outcome(F.col("status"), reasons).alias("o")).collect()
    assert [r.o for r in got] == ["success", "degraded", "failure", "skipped", "failure"]
    assert got[1].r == ["source_acquisition", "ingestion_stall"]


def test_recent_and_last(spark):
    df = ledger_rows(spark, [run(profile=f"p{i % 3}") for i in range(130)] + [])
    assert [r.run_id for r in ledger.recent(df, 3).collect()] == [129, 128, 127]
    assert ledger.recent(df, 1000).count() == 100 and ledger.recent(df, 0).count() == 1
    assert {r.profile: r.run_id for r in ledger.last_by_profile(df).collect()} == {"p0": 129, "p1": 127, "p2": 128}
    assert [r.run_id for r in ledger.tail(df, 2, ["run_id"]).collect()] == [128, 129]
    assert ledger.tail(df, 0, ["run_id"]).count() == 130


def test_cadence_windows(spark):
    df = ledger_rows(spark, [run() for _ in range(8)] + [run(status="failed")])
    rows = ledger.cadence(df, 3).orderBy("run_id").collect()
    assert [(r.window_id, r.emits) for r in rows] == [(0, False), (0, False), (0, True), (1, False), (1, False), (1, True), (2, False), (2, False)]
    assert ledger.cadence(df, 0).count() == 0


def test_overall_status(spark):
    schema = "probe_id INT, target STRING, ts TIMESTAMP, status STRING"
    t0 = datetime(2024, 1, 1, 12)

    def state(rows, **kw):
        now = F.lit((t0 + timedelta(seconds=60)).replace(tzinfo=timezone.utc))
        return ledger.overall_status(spark.createDataFrame(rows, schema), now, **kw).first().overall

    assert state([]) == "starting"
    assert state([(1, "a", t0, "degraded"), (2, "a", t0 + timedelta(seconds=1), "ok")]) == "ok"
    assert state([(1, "a", t0, "ok"), (2, "b", t0, "degraded")]) == "degraded"
    assert state([(1, "a", t0, "ok")], latched=True) == "degraded"
    assert state([(1, "a", t0 - timedelta(hours=1), "ok")]) == "degraded"


def test_active_rows_and_run_lookup(spark):
    done = ledger_rows(spark, [run()])
    active = spark.createDataFrame([(7, "p", "manual", START), (8, "p", "manual", START)], "run_id INT, profile STRING, kind STRING, started_at TIMESTAMP")
    assert [r.run_id for r in ledger.active_runs(active).collect()] == [8, 7]
    assert ledger.all_runs(done, active).count() == 3
    logs = spark.createDataFrame([(7, "x"), (9, "y")], "run_id INT, message STRING")
    assert ledger.run_logs(ledger.all_runs(done, active), logs).count() == 1


def test_quantiles_against_numpy(spark):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.8 else "b", float(rng.randrange(50))) for _ in range(999)]
    df = spark.createDataFrame(data, "k STRING, v DOUBLE")
    for q in (0.0, 0.5, 0.95, 1.0):
        got = {r.k: r.quantile for r in reports.exact_quantile(df, ["k"], "v", q).collect()}
        for key in ("hot", "b"):
            want = np.quantile([v for k, v in data if k == key], q)
            assert abs(got[key] - want) < 1e-9


def test_histogram_quantile_stays_in_its_bucket(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 40, 5000)], "k STRING, v DOUBLE")
    assert reports.histogram_quantile(df, ["k"], "v", 0.99).first().quantile == 3600.0
    mid = reports.histogram_quantile(df, ["k"], "v", 0.5).first().quantile
    assert 1.0 < mid <= 5.0


def test_squatters_pair_ids_with_slugs(spark):
    rows = [
        ("t2", "WARNING", "slug_collision", "m", "existing_id=aaaaaaaa; Slug 'one' already in use", "u1", "T"),
        ("t1", "WARNING", "x", "slug_collision seen: existing_id=aaaaaaaa", "", "", ""),
        ("t3", "WARNING", "slug_collision", "m", "first_existing_id=aaaaaaaa; Slug 'one' already in use retry_existing_id=bbbbbbbb; Slug 'two' already in use", "u2", "T"),
        ("t9", "INFO", "slug_collision", "m", "existing_id=aaaaaaaa", "u", "T"),
        ("t9", "WARNING", "other", "m", "existing_id=aaaaaaaa", "u", "T"),
    ]
    logs = spark.createDataFrame(rows, "timestamp STRING, level STRING, status STRING, message STRING, detail STRING, source_url STRING, title STRING")
    mentions = reports.squatter_mentions(logs)
    got = {r.doc_id: r for r in reports.squatters(mentions).collect()}
    a = got["aaaaaaaa"]
    assert (a.n, a.first_seen, a.last_seen, a.n_slugs, a.n_urls, a.n_titles) == (3, "t1", "t3", 1, 2, 1)
    values = {(r.doc_id, r.field, r.value) for r in reports.squatter_values(mentions).collect()}
    assert ("bbbbbbbb", "slug", "two") in values and ("aaaaaaaa", "slug", "two") not in values


def test_funnel_total_and_metrics(spark):
    items = spark.createDataFrame(
        [("p", "a", "pass", True, "created"), ("p", "a", "drop", False, None), ("q", "b", "pass", False, "version_conflict")],
        "profile STRING, source STRING, decision STRING, cache_hit BOOLEAN, write_status STRING")
    total = [r for r in reports.funnel(items, totals=True).collect() if r.profile is None][0]
    assert (total.fetched, total.filter_pass, total.created, total.failed, total.cache_hits) == (3, 2, 1, 1, 1)
    rows = reports.metrics_long(items, [
        reports.reading("store_writes", F.col("write_status").isNotNull(), profile=F.col("profile"), source=F.col("source"), status=F.col("write_status")),
        reports.reading("slug_collision_reclaimed")]).collect()
    assert {(r["name"], r["labels"].get("status"), r["value"]) for r in rows} == {
        ("store_writes", "created", 1.0), ("store_writes", "version_conflict", 1.0), ("slug_collision_reclaimed", None, 3.0)}
    with pytest.raises(ValueError):
        reports.reading("cache_hits", note_id=F.lit(1))
    assert len(reports.INSTRUMENTS) == 18


def test_backfill_total_is_strict(spark):
    def total(n):
        return reports.backfill_total(spark.createDataFrame([(n, 1, 200), (5, None, None), (-4, 3, 200)], "days INT, n_categories INT, max_results INT")).first()

    assert (total(5).total, total(5).confirm_required, total(6).confirm_required) == (1000, False, True)


def test_config_rules(spark):
    profiles = feeds.profiles_table(spark, [{"profile": "ok-1"}, {"profile": "Bad"}, {"profile": "ok-1"}])
    sources = feeds.sources_table(spark, [
        {"profile": "ok-1", "kind": "rss", "source_key": "https://f", "feed_name": "F", "source_tag": "rss"},
        {"profile": "ok-1", "kind": "rss", "source_key": "gopher://f", "feed_name": "!!", "source_tag": "news"}])
    sinks = feeds.sinks_table(spark, [{"name": "a", "url": "https://x"}, {"name": "a", "url": "x", "type": "toast"}, {"name": "-b", "url": "http://x"}])
    got = {(r.object, r.name, r.problem) for r in predicates.config_violations(profiles, sources, sinks).collect()}
    assert got == {
        ("profile", "Bad", "bad_name"), ("profile", "ok-1", "duplicate_name"), ("feed", "!!", "empty_slug"), ("feed", "!!", "bad_url"),
        ("feed", "!!", "bad_source_tag"), ("sink", "a", "bad_url"), ("sink", "a", "bad_mode"), ("sink", "a", "duplicate_name"),
        ("sink", "-b", "bad_name")}
    assert profiles.first().relevance == 7 and profiles.first().edge_score == 0.75


def test_sinks_and_gates(spark):
    none = feeds.sinks_table(spark, [])
    assert predicates.effective_sinks(none).count() == 0
    assert predicates.effective_sinks(none, "https://x").first().type == "digest"
    sinks = feeds.sinks_table(spark, [{"name": "d", "min_score": 8}, {"name": "off", "enabled": False},
                                      {"name": "t", "type": "toast", "event_mode": "article", "min_score": 8}])
    assert predicates.effective_sinks(sinks, "https://x").count() == 3
    runs = spark.createDataFrame([("r1", "p", "manual"), ("r2", "p", "manual"), ("r3", "p", "backfill")], "run_id STRING, profile STRING, kind STRING")
    items = spark.createDataFrame([("r1", "i1", 9), ("r1", "i2", 3), ("r3", "i3", 9)], "run_id STRING, item_id STRING, score INT")
    got = {(r.run_id, r.sink, r.item_id) for r in predicates.notify_sinks(sinks, runs, items).collect()}
    assert got == {("r1", "d", None), ("r1", "t", "i1")}
    profiles = feeds.profiles_table(spark, [{"profile": "p"}, {"profile": "q", "enabled": False}])
    sources = feeds.sources_table(spark, [{"profile": p, "kind": "rss", "source_key": p, "enabled": e} for p, e in (("p", True), ("q", True), ("z", True), ("p", False))])
    assert predicates.enabled_sources(sources, profiles).count() == 1


def test_predicates(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 2)), (" ", datetime(2024, 1, 3)), (None, datetime(2024, 1, 4))], "t STRING, published TIMESTAMP")
    assert predicates.require_fields(df, ["t", "published"]).count() == 1
    now = datetime(2024, 1, 5, tzinfo=timezone.utc)
    assert predicates.lookback(df, 2, now).count() == 2
    assert predicates.backfill_window(df, datetime(2024, 1, 2).date(), datetime(2024, 1, 4).date()).count() == 2
    edges = spark.createDataFrame([(0.75,), (0.7,)], "score DOUBLE")
    assert predicates.edge_gate(edges).count() == 1
