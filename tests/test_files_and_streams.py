from __future__ import annotations

import json
from collections import Counter
from datetime import date, datetime, timedelta, timezone

import pandas as pd
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.operators import ledger, reports
from gleaner.operators.repair import attempts_and_cap
from gleaner.plans import run_plan
from gleaner.schemas import EDGES, NOTES, RUNS
from gleaner.sinks import generations, writers
from gleaner.sources import feeds, files
from gleaner.streaming import keyed, upserts, windows
from gleaner.vocabulary import TAGS

ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom">
<entry><id>http://arxiv.org/abs/2601.00001v2</id><title type="text">A title
  over lines</title><summary>  Text. </summary><published>2026-01-02T03:04:05Z</published><category term="cs.AI"/><category term="cs.LG"/></entry>
<entry><id>http://arxiv.org/abs/2601.00002</id><title>One category</title><summary>S</summary><published>2026-01-01T00:00:00Z</published><category term="cs.AI"/></entry>
<entry><id>http://arxiv.org/abs/2601.00003</id><title>No summary</title><published>2026-01-01T00:00:00Z</published></entry></feed>"""
RSS = """<rss version="2.0"><channel><title>F</title>
<item><title>First</title><link>https://b.org/1?utm_source=x</link><pubDate>Tue, 06 Jan 2026 10:00:00 +0000</pubDate><description>d</description></item>
<item><title>No link</title></item></channel></rss>"""
BLOG = """<feed xmlns="http://www.w3.org/2005/Atom">
<entry><title>Post</title><link rel="self" href="https://b.org/self"/><link rel="alternate" href="https://b.org/post"/><updated>2026-01-07T00:00:00Z</updated><summary>s</summary></entry></feed>"""


def test_atom_and_rss(spark, tmp_path):
    (tmp_path / "a.xml").write_text(ATOM)
    atom = feeds.to_candidates(feeds.read_atom(spark, str(tmp_path / "a.xml")), "arxiv").orderBy("item_id").collect()
    assert [(r.item_id, r.title, r.abstract, r.categories) for r in atom] == [
        ("2601.00001", "A title over lines", "Text.", ["cs.AI", "cs.LG"]), ("2601.00002", "One category", "S", ["cs.AI"])]
    assert atom[0].source_url == "https://arxiv.org/abs/2601.00001" and atom[0].published == datetime(2026, 1, 2, 3, 4, 5)
    (tmp_path / "empty.xml").write_text('<feed xmlns="http://www.w3.org/2005/Atom"></feed>')
    assert feeds.read_atom(spark, str(tmp_path / "empty.xml")).count() == 0
    folder = tmp_path / "feeds"
    folder.mkdir()
    (folder / "rss.xml").write_text(RSS)
    (folder / "blog.xml").write_text(BLOG)
    which = spark.createDataFrame([("rss.xml", "https://b.org/rss", "rss", "Feed R"), ("blog.xml", "https://b.org/atom", "blog", "Feed B")],
                                  "file STRING, feed_url STRING, source_tag STRING, feed_name STRING")
    rows = feeds.read_rss(spark, str(folder), which).orderBy(F.col("published").desc(), "url").collect()
    assert [(r.title, r.url, r.source_tag, r.published.day) for r in rows] == [
        ("Post", "https://b.org/post", "blog", 7), ("First", "https://b.org/1?utm_source=x", "rss", 6)]
    both = feeds.union_sources(feeds.to_candidates(feeds.read_atom(spark, str(tmp_path / "a.xml")), "arxiv"),
                               feeds.to_candidates(feeds.read_rss(spark, str(folder), which), "rss"))
    assert both.count() == 4
    named = feeds.archive_item_id(feeds.to_candidates(feeds.read_rss(spark, str(folder), which), "rss")).collect()
    assert any(r.archive_item_id.startswith("feed-r-2026-01-06-") for r in named)
    assert feeds.newest_first(both).first().title == "Post"


def test_ledger_files(spark, tmp_path):
    row = {"run_id": "r1", "profile": "p", "kind": "manual", "status": "completed", "run_range": {"days": "1"},
           "started_at": "2026-01-01T00:00:00+00:00", "completed_at": "2026-01-01T00:01:00+00:00", "source_acquisition_errors": []}
    (tmp_path / "runs.jsonl").write_text(json.dumps(row) + "\n\nnot json\n[1, 2]\n{\"run_id\": 7\n")
    good, bad = files.read_json_lines(spark, str(tmp_path / "runs.jsonl"), RUNS)
    assert good.count() == 1 and bad.count() == 3
    r = files.read_runs(spark, str(tmp_path / "runs.jsonl")).withColumn(
        "d", ledger.run_duration(F.col("started_ts"), F.col("completed_ts"))).first()
    assert r.run_range == {"days": "1"} and r.d == 60.0
    (tmp_path / "active.json").write_text(json.dumps({"a": {"profile": "p", "kind": "manual"}, "b": 5, "c": {"run_id": "c", "profile": "q"}}))
    assert {(r.run_id, r.profile) for r in files.read_active_runs(spark, str(tmp_path / "active.json")).collect()} == {("a", "p"), ("c", "q")}
    (tmp_path / "broken.json").write_text("{oops")
    assert files.read_active_runs(spark, str(tmp_path / "broken.json")).count() == 0
    writers.append_runs(good, str(tmp_path / "out"))
    writers.append_runs(good, str(tmp_path / "out"))
    assert files.read_runs(spark, str(tmp_path / "out")).count() == 2


def test_logs(spark, tmp_path):
    (tmp_path / "log").write_text('banner\n {"level":"WARNING","message":"m","custom":{"x":1}}\n{broken\n[1]\n')
    logs = files.read_logs(spark, str(tmp_path / "log"))
    assert [(r.level, r.x) for r in logs.select("level", F.expr("variant_get(extra, '$.custom.x', 'int')").alias("x")).collect()] == [("WARNING", 1)]


def test_archive(spark, tmp_path):
    for name in ("arxiv/2026/01/2601.00001.pdf", "blog/2026/02/x.html", "stray.txt"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"12345")
    got = {(r.source, r.year, r.month, r.item_id, r.extractor) for r in files.read_archive(spark, str(tmp_path)).collect()}
    assert got == {("arxiv", 2026, 1, "2601.00001", "pdf"), ("blog", 2026, 2, "x", "html")}
    assert {(r.source, r.files, r.bytes) for r in reports.archive_inventory(files.read_archive(spark, str(tmp_path))).collect()} == {
        ("arxiv", 1, 5), ("blog", 1, 5)}
    assert files.read_archive(spark, str(tmp_path), content=True).where("length(content) = 5").count() == 2


def full_note(**kw):
    return {"note_id": "n", "version": 1, "title": "T", "slug": "t", "path": "p", "source_url": "https://e.com", "tags": [TAGS.ingested_by],
            "confidence": 0.9, "archive_path": None, "summary": "s", "full_text": None, "tier1": None, "tier3": None,
            "relevance": [("p", 9, "r")], "repair": None, "user_notes": None, "updated_at": datetime(2026, 1, 5), **kw}


def notes_frame(spark, rows):
    names = [f.name for f in spark.createDataFrame([], NOTES).schema]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], NOTES).withColumn("published", F.col("updated_at")).withColumn(
        "source_tag", F.when(F.col("note_id").startswith("a"), "blog").otherwise("arxiv"))


def test_note_sinks(spark, tmp_path):
    notes = notes_frame(spark, [full_note(), full_note(note_id="a1", slug="a"), full_note(note_id="bad", tags=[])])
    writers.write_notes(notes.where("note_id <> 'bad'"), str(tmp_path / "notes"))
    writers.write_notes(notes.where("note_id = 'a1'").withColumn("version", F.lit(9).cast("bigint")), str(tmp_path / "notes"))
    schema = f"{NOTES}, published TIMESTAMP, source_tag STRING, kind STRING, source STRING, year STRING, month STRING"

    def table():
        return writers.read_notes_table(spark, str(tmp_path / "notes"), schema)

    back = {(r.kind, r.source, r.year, r.month): r.version for r in table().collect()}
    assert back == {("papers", "arxiv", "2026", "01"): 1, ("articles", "blog", "2026", "01"): 9}
    # other notes of the month stay, and a note that changes its month leaves the old one
    one = notes.where("note_id = 'a1'")
    writers.write_notes(one.withColumn("note_id", F.lit("a2")), str(tmp_path / "notes"))
    writers.write_notes(one.withColumn("published", F.add_months("published", 1).cast("timestamp")), str(tmp_path / "notes"))
    assert {(r.note_id, r.month) for r in table().where("source = 'blog'").collect()} == {("a1", "02"), ("a2", "01")}
    # names that need escaping, and none
    odd = one.withColumn("note_id", F.lit("o")).withColumn("source_tag", F.lit("a/b=c %"))
    writers.write_notes(odd.unionByName(odd.withColumn("note_id", F.lit("n")).withColumn("source_tag", F.lit(None).cast("string"))),
                        str(tmp_path / "notes"))
    writers.write_notes(odd.withColumn("version", F.lit(5).cast("bigint")), str(tmp_path / "notes"))
    assert {(r.note_id, r.source, r.version) for r in table().where("note_id in ('o', 'n')").collect()} == {
        ("o", "a/b=c %", 5), ("n", None, 1)}
    refused = writers.render_notes(notes, str(tmp_path / "text"))
    assert [r.problem for r in refused.collect()] == ["missing_ingested_by"]
    texts = spark.read.json(str(tmp_path / "text")).select(F.col("slug").alias("file"), "text")
    assert {r.title for r in files.parse_notes(texts)[0].collect()} == {"T"}
    folder = tmp_path / "md"
    folder.mkdir()
    (folder / "x.md").write_text(texts.first().text)
    (folder / "y.md").write_text("nothing")
    good, bad = files.read_notes(spark, str(folder))
    assert good.count() == 1 and bad.first().error == "no_front_matter"


class Killed(Exception):
    pass


@pytest.mark.parametrize("dies", range(6))
def test_a_killed_write_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, dies):
    """Every folder that is made or dropped is a place to die; whatever the place, no reader sees a mixture."""
    path = str(tmp_path / "t")

    def edges(score, *sources):
        return spark.createDataFrame([("related_to", s, "t", ("k", score)) for s in sources], EDGES)

    def seen():
        return {(r.source_note_id, r.evidence.score) for r in writers.read_edges(spark, path).collect()}

    for score in (1.0, 2.0):
        writers.write_edges(edges(score, "a", "b", "c"), path, 2)
    old, new = seen(), {("a", 3.0), ("b", 2.0), ("c", 2.0), ("d", 3.0)}
    left, drop = [dies], generations.drop_folder

    def maybe(action):
        def run(*args, **kw):
            left[0] -= 1
            if left[0] < 0:
                raise Killed
            return action(*args, **kw)
        return run

    monkeypatch.setattr(DataFrameWriter, "parquet", maybe(DataFrameWriter.parquet))
    monkeypatch.setattr(DataFrameWriter, "json", maybe(DataFrameWriter.json))
    monkeypatch.setattr(generations, "drop_folder", maybe(drop))
    try:
        writers.write_edges(edges(3.0, "a", "d"), path, 2)
        done = True
    except Killed:
        done = False
    monkeypatch.undo()
    assert seen() == (new if done or dies > 1 else old) and old == {(s, 2.0) for s in "abc"}
    # half a list is no list
    half = tmp_path / "t" / "list" / "v=99"
    half.mkdir()
    (half / "part-0.json").write_text('{"part":"bucket=0","gen":77}')
    assert seen() == (new if done or dies > 1 else old)
    writers.write_edges(edges(3.0, "a", "d"), path, 2)
    assert seen() == new


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "t")
    many = spark.range(400).selectExpr("'related_to' as type", "cast(id as string) as source_note_id", "'t' as target_note_id",
                                       "named_struct('kind', 'k', 'score', 1.0D) as evidence")
    writers.write_edges(many, path, 32)
    writers.write_edges(many.where("source_note_id = '7'"), path, 32)
    table = generations.Generations(spark, path, ["bucket"])
    assert sorted(Counter(table.current().values()).values()) == [1, 31] and writers.read_edges(spark, path).count() == 400


def test_other_sinks(spark, tmp_path):
    edges = spark.createDataFrame([("builds_on", "a", "b", ("k", 1.0))], EDGES)
    path = str(tmp_path / "edges")
    writers.write_edges(edges, path)
    writers.write_edges(edges, path)
    assert writers.read_edges(spark, path).count() == 1
    results = spark.createDataFrame([("x", "slug_collision", "d"), ("y", "created", "")], "item_id STRING, status STRING, detail STRING")
    writers.append_collisions(results, str(tmp_path / "c"))
    assert files.read_collisions(spark, str(tmp_path / "c")).count() == 1
    writers.write_digests(spark.createDataFrame([("s", "{}")], "sink STRING, payload STRING"), str(tmp_path / "d"))
    assert (tmp_path / "d" / "sink=s").exists()
    runs = spark.createDataFrame([("p", "manual")], "profile STRING, kind STRING")
    metric = reports.metrics_long(runs, [reports.reading("run_starts", profile=F.col("profile"), kind=F.col("kind"))])
    writers.write_metrics(metric, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).first().value == 1.0
    placed = writers.archive_layout(spark.createDataFrame([("blog", datetime(2026, 3, 1), "id", ".pdf")], "source_tag STRING, published TIMESTAMP, item_id STRING, ext STRING"))
    assert placed.first().archive_path == "blog/2026/03/id.pdf"


def test_bucketed_store_is_not_shuffled(spark):
    notes = spark.range(200).select(F.concat(F.lit("https://e.com/"), "id").alias("source_url"), F.col("id").cast("string").alias("note_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        writers.save_notes_table(notes, "bucketed_notes", 4)
        joined = notes.where("note_id < 50").join(spark.table("bucketed_notes"), "source_url")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and joined.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS bucketed_notes")
    writers_in = spark.createDataFrame([("p", "t", ["a", "a"])], "profile STRING, title STRING, filter_tags ARRAY<STRING>")
    import tempfile

    path = tempfile.mkdtemp(prefix="spark-") + "/tags"
    writers.append_filter_tags(writers_in, path)
    assert spark.read.parquet(path).first().tags == ["a"]


# ---- streams: equal to their batch twins over several micro-batches ------------------------------------------------

def batches(spark, df, folder, order, n=3):
    """Write the rows as n time-ordered files and stream them one file at a time."""
    part = F.ntile(n).over(Window.orderBy(*order))
    cut = df.withColumn("_part", part).persist()
    for i in range(n):
        cut.where(F.col("_part") == i + 1).drop("_part").coalesce(1).write.mode("append").parquet(str(folder))
    cut.unpersist()
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def run_to_end(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("kind", ["stalls", "circuit", "attempts", "cadence"])
def test_keyed_state_equals_batch(spark, tables, tmp_path, kind):
    if kind == "stalls":
        df, order = tables.runs_v.withColumn("profile", F.col("profile") % 5), ["completed_at", "run_id"]
        of, want, cols = keyed.stalls, ledger.stall_flags(df), ("run_id", "ingestion_stall", "fetch_stall")
    elif kind == "circuit":
        df, order = tables.probes_v.withColumn("target", F.col("target") % 5), ["ts", "probe_id"]
        of, want, cols = keyed.breaker, ledger.circuit(df), ("probe_id", "bad_streak", "circuit_open")
    elif kind == "attempts":
        df, order = tables.attempts_v, ["ts", "attempt_id"]
        of, want, cols = keyed.attempts, attempts_and_cap(df), ("attempt_id", "n_counted", "terminal", "flips")
    else:
        df, order = tables.runs_v.withColumn("profile", F.col("profile") % 5), ["completed_at", "run_id"]
        tags, bad = F.array("kind"), F.col("run_id") % 3 == 0
        numbered = ledger.cadence(df, 7)
        closed = numbered.where("emits").select("profile", "window_id")
        items = numbered.join(closed, ["profile", "window_id"], "left_semi").select(
            "profile", "window_id", bad.alias("rejected"), tags.alias("tags"))
        of, want, cols = (lambda s: keyed.closed_windows(s, 7, tags, bad)), items, ("profile", "window_id", "rejected", "tags")
    out = of(batches(spark, df, tmp_path / "in", order))
    run_to_end(out.writeStream.format("parquet").option("path", str(tmp_path / "o")).option(
        "checkpointLocation", str(tmp_path / "cp")))
    assert rows(spark.read.schema(out.schema).parquet(str(tmp_path / "o")), *cols) == rows(want, *cols)


def test_late_rows_per_key(spark, tmp_path):
    """Each key has its own clock: rows behind another key are in time, rows behind their own are counted and marked."""
    (tmp_path / "in").mkdir()
    schema = "attempt_id INT, note_id STRING, stage STRING, ts TIMESTAMP, failure_stage STRING"
    parts = [[(1, "a", 10), (2, None, 4)], [(3, "b", 5), (4, "b", 6), (5, "b", 11), (6, "a", 9), (7, None, None)], [(8, "b", 11), (9, "a", 12)]]
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for part in parts:
        data = [(i, n, "tier2", h and datetime(2026, 1, 1, h), "parse") for i, n, h in part]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        out = keyed.attempts(stream)
        run_to_end(out.writeStream.format("parquet").option("path", str(tmp_path / "o")).option(
            "checkpointLocation", str(tmp_path / "cp")))
    got = {r.attempt_id: (r.n_counted, r.flips, r.late) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    assert got == {1: (1, False, False), 2: (1, False, False), 3: (1, False, False), 4: (2, False, False), 5: (3, True, False),
                   6: (2, False, True), 7: (2, False, False), 8: (4, False, False), 9: (3, True, False)}


@pytest.mark.parametrize("kind", ["attempts", "circuit", "stalls", "cadence", "abandoned"])
def test_state_is_kept_by_bucket(spark, tmp_path, kind):
    """Calls of Python and rows of state follow the buckets, not the keys; big numbers beside nulls come out as they were."""
    (tmp_path / "in").mkdir()
    big = 2**53 + 1
    df = spark.range(300).selectExpr(
        f"if(id < 10, null, id + {big}) as k", f"if(id % 7 = 0, null, id + {big}) as n", "timestamp_seconds(id) as ts",
        "'parse' as failure_stage", "'tier2' as stage", "'degraded' as status", "'scheduled' as kind", "1 as checked")
    df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    probes = stream.selectExpr("n as probe_id", "k as target", "ts", "status")
    runs = stream.selectExpr("n as run_id", "k as profile", "kind", "'completed' as status", "ts as completed_at",
                             "checked as sources_checked", "checked as ingested")
    tried = stream.selectExpr("n as attempt_id", "k as note_id", "stage", "ts", "failure_stage")
    out = {
        "attempts": lambda: keyed.attempts(tried, buckets=4),
        "circuit": lambda: keyed.breaker(probes, buckets=4),
        "stalls": lambda: keyed.stalls(runs, buckets=4),
        "cadence": lambda: keyed.closed_windows(runs, 1, F.array("kind"), F.lit(False), buckets=4),
        "abandoned": lambda: keyed.abandoned(runs.withColumnRenamed("completed_at", "started_at"), runs.where("false"),
                                             timedelta(minutes=5), buckets=4)}[kind]()
    query = out.writeStream.format("parquet").option("path", str(tmp_path / "o")).option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    held = max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress)
    assert 0 < held <= 4 * 4
    id_, key = {"attempts": ("attempt_id", "note_id"), "circuit": ("probe_id", "target"), "stalls": ("run_id", "profile")}.get(
        kind, (None, "profile"))
    got = spark.read.schema(out.schema).parquet(str(tmp_path / "o"))
    if kind == "abandoned":
        assert got.count() == 0
    else:
        assert sorted(got.select(key).collect(), key=repr) == sorted(df.select("k").collect(), key=repr)
    if id_:
        assert sorted(got.select(id_).collect(), key=repr) == sorted(df.select("n").collect(), key=repr)


def test_abandoned_by_timer(spark, tmp_path):
    """A start is told at its deadline though no row of it follows; a finished row may come first, but not too early."""
    (tmp_path / "in").mkdir()
    schema = "run_id LONG, profile STRING, at TIMESTAMP, kind STRING"
    day = [(1, 0, "s"), (1, 1, "f"), (2, 0, "s"), (3, 2, "f"), (4, 1, "f"), (4, 2, "s"), (5, 3, "s"), (5, 10, "f"), (6, 20, "s")]
    data = [(i, f"p{i}", datetime(2026, 1, 1, h), k) for i, h, k in day] + [(None, "n", datetime(2026, 1, 1), "s"), (7, "p", None, "s")]
    parts = [data[:3], data[3:6], data[6:], [(3, "p3", datetime(2026, 1, 1, 1), "s")]]
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    out = keyed.abandoned(stream.where("kind = 's'").withColumnRenamed("at", "started_at"),
                          stream.where("kind = 'f'").withColumnRenamed("at", "completed_at"), timedelta(hours=6))
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        run_to_end(out.writeStream.format("parquet").option("path", str(tmp_path / "o")).option(
            "checkpointLocation", str(tmp_path / "cp")))
    got = rows(spark.read.schema(out.schema).parquet(str(tmp_path / "o")), "run_id", "profile", "started_at", "status")
    assert [g[0] for g in got] == [2, 4, 5] and got[0] == (2, "p2", datetime(2026, 1, 1), "abandoned")


def test_dedupe_and_rates(spark, tmp_path):
    data = [(i, "a" if i % 2 else "b", datetime(2026, 1, 1, i % 20, i % 60), "slug_collision" if i % 3 else "created") for i in range(60)]
    df = spark.createDataFrame(data, "id INT, k STRING, ts TIMESTAMP, status STRING")
    stream = batches(spark, df, tmp_path / "in", ["ts"])
    out = windows.stream_dedupe(stream.select("k", "ts"), ["k"], "3 days", "ts")
    run_to_end(out.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c1")))
    assert rows(spark.read.parquet(str(tmp_path / "o")), "k") == [("a",), ("b",)]
    counts = windows.failing_write_counts(stream.select("ts", "status"))
    run_to_end(counts.writeStream.outputMode("complete").format("memory").queryName("rates").option("checkpointLocation", str(tmp_path / "c2")))
    assert sum(r.n for r in spark.table("rates").collect()) == sum(1 for d in data if d[3] == "slug_collision")
    assert windows.drop_late(df, 1, F.lit(datetime(2026, 1, 2, 12)), "ts").count() == sum(1 for d in data if d[2].hour >= 12)


def test_abandoned_stream(spark, tmp_path):
    starts = spark.createDataFrame([(i, "p", datetime(2026, 1, 1, i)) for i in range(20)], "run_id INT, profile STRING, started_at TIMESTAMP")
    done = spark.createDataFrame([(i, datetime(2026, 1, 1, i, 30)) for i in range(20) if i != 3], "run_id INT, completed_at TIMESTAMP")
    s = batches(spark, starts, tmp_path / "s", ["started_at"])
    d = batches(spark, done, tmp_path / "d", ["completed_at"])
    out = windows.abandoned_stream(s, d, "6 HOURS")
    run_to_end(out.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")))
    assert rows(spark.read.schema(out.schema).parquet(str(tmp_path / "o")), "run_id", "status") == [(3, "abandoned")]


def test_candidate_streams(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.xml").write_text(ATOM)
    (tmp_path / "x" / "b.xml").write_text(ATOM)
    out = windows.stream_dedupe(feeds.stream_atom(spark, str(tmp_path / "x"), 1), ["item_id"])
    run_to_end(out.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")))
    assert rows(spark.read.parquet(str(tmp_path / "o")), "item_id") == [("2601.00001",), ("2601.00002",)]
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "a.json").write_text('{"item_id": "z"}\n')
    stream = feeds.stream_candidates(spark, str(tmp_path / "j"), "item_id STRING")
    run_to_end(stream.writeStream.format("memory").queryName("cands").option("checkpointLocation", str(tmp_path / "c2")))
    assert spark.table("cands").count() == 1


INCOMING = "profile STRING, item_id STRING, title STRING, source_url STRING, score INT, reason STRING, tags ARRAY<STRING>, user_notes STRING"


def arrive(spark, *items):
    return spark.createDataFrame([(p, i, t, u, 8, "r", [f"profile:{p}", TAGS.ingested_by], None) for p, i, t, u in items], INCOMING)


def test_upsert_stream_is_applied_once(spark, tmp_path):
    step = upserts.upsert_step(str(tmp_path), fold_every=2)
    step(arrive(spark, ("p", "1", "One", "https://e.com/1"), ("p", "2", "Two", "https://e.com/2")), 0)
    second = arrive(spark, ("q", "3", "One", "https://e.com/1"), ("p", "4", "Two", "https://f.org/4"))
    step(second, 1)
    assert upserts.NoteTable(spark, str(tmp_path)).parts() == (1, [])
    # run again after the fold: the table as it stood before the batch is still there
    step(second, 1)
    got = {r.source_url: r for r in upserts.read_store(spark, str(tmp_path)).collect()}
    assert got["https://e.com/1"].version == 2 and {e.profile for e in got["https://e.com/1"].relevance} == {"p", "q"}
    assert got["https://f.org/4"].title == "Two [f.org]" and got["https://e.com/2"].version == 1 and len(got) == 3
    results = spark.read.parquet(f"{tmp_path}/results").collect()
    assert sorted((r.batch, r.item_id, r.status) for r in results) == [
        (0, "1", "created"), (0, "2", "created"), (1, "3", "updated"), (1, "4", "created")]


def test_a_batch_that_died_leaves_the_table_as_it_was(spark, tmp_path):
    step = upserts.upsert_step(str(tmp_path))
    step(arrive(spark, ("p", "1", "One", "https://e.com/1")), 0)
    # half a delta: files but no mark
    half = tmp_path / "delta" / "batch=1"
    spark.read.parquet(str(tmp_path / "delta" / "batch=0")).withColumn("title", F.lit("half")).write.parquet(str(half))
    (half / "_SUCCESS").unlink()
    assert [r.title for r in upserts.read_store(spark, str(tmp_path)).collect()] == ["One"]
    step(arrive(spark, ("p", "2", "Two", "https://e.com/2")), 1)
    assert sorted(r.title for r in upserts.read_store(spark, str(tmp_path)).collect()) == ["One", "Two"]


def test_deltas_grow_with_the_batch_and_old_folders_go(spark, tmp_path):
    step = upserts.upsert_step(str(tmp_path), fold_every=2)
    for i in range(5):
        step(arrive(spark, ("p", str(i), f"Note {i}", f"https://e.com/{i}"), ("q", f"x{i}", "Note 0", "https://e.com/0")), i)
        assert spark.read.parquet(f"{tmp_path}/delta/batch={i}").count() == (1 if i == 0 else 2)
    assert sorted(p.name for p in (tmp_path / "base").iterdir()) == ["upto=1", "upto=3"]
    assert sorted(p.name for p in (tmp_path / "delta").iterdir()) == [f"batch={i}" for i in (2, 3, 4)]
    got = {r.source_url: r.version for r in upserts.read_store(spark, str(tmp_path)).collect()}
    assert got == {**{f"https://e.com/{i}": 1 for i in range(5)}, "https://e.com/0": 5}


def test_streamed_store_keeps_content_and_drops_reclaimed_notes(spark, tmp_path, monkeypatch):
    """Several batches give what one batch upsert gives, with whole notes, over several places."""
    monkeypatch.setattr(upserts, "PLACE_ROWS", 1)
    blank = dict.fromkeys(f.name for f in spark.createDataFrame([], NOTES).schema)
    stored = [{"note_id": f"r{i}", "title": "Residue", "slug": "residue", "source_url": "", "tags": [], "version": 1} for i in range(2)]
    stored.append({"note_id": "k", "title": "Kept", "slug": "kept", "source_url": "", "tags": [], "full_text": "says", "version": 1})
    # the second try of a title meets this one
    stored.append({"note_id": "h", "title": "Held [e.com]", "slug": "held-e-com", "source_url": "https://x.org/h", "tags": [], "version": 1})
    stored.append({"note_id": "g", "title": "Held", "slug": "held", "source_url": "https://x.org/g", "tags": [], "version": 1})
    upserts.seed(spark.createDataFrame([tuple({**blank, **r}.values()) for r in stored], NOTES), str(tmp_path))
    batches = [arrive(spark, ("p", "1", "Residue", "https://e.com/1"), ("p", "2", "Kept", "https://e.com/2")),
               arrive(spark, ("q", "3", "Residue", "https://e.com/1"), ("q", "5", "Held", "https://e.com/5")),
               arrive(spark, ("p", "4", "New", "https://e.com/4"))]
    step = upserts.upsert_step(str(tmp_path), fold_every=2)
    for i, batch in enumerate(batches):
        step(batch.withColumn("full_text", F.concat(F.lit("text "), "item_id")).withColumn("summary", F.lit("s")), i)
    got = {r.note_id: r for r in upserts.read_store(spark, str(tmp_path)).collect()}
    assert "r0" not in got and got["k"].full_text == "says" and len(got) == 7
    by_url = {r.source_url: (r.title, r.slug, r.full_text, r.summary, r.version) for r in got.values() if "e.com" in r.source_url}
    assert by_url == {"https://e.com/1": ("Residue", "residue", "text 3", "s", 2),
                      "https://e.com/2": ("Kept [e.com]", "kept-e-com", "text 2", "s", 1),
                      "https://e.com/4": ("New", "new", "text 4", "s", 1)}
    assert [r.status for r in spark.read.parquet(f"{tmp_path}/results").where("item_id = '5'").collect()] == ["slug_collision"]


def test_a_stream_waits_while_the_breaker_is_open(spark, tmp_path):
    seen, breaker_open = [], [True]
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("v INT").parquet(str(tmp_path / "in"))

    def run(value):
        spark.createDataFrame([(value,)], "v INT").write.mode("append").parquet(str(tmp_path / "in"))
        writer = stream.writeStream.foreachBatch(lambda df, n: seen.append(sorted(r.v for r in df.collect()))).option(
            "checkpointLocation", str(tmp_path / "cp"))
        return upserts.run_unless_open(writer, lambda: breaker_open[0], spark, str(tmp_path / "runs"), "p")

    assert [run(1), run(2)] == [False, False] and seen == []
    breaker_open[0] = False
    assert run(3) and seen == [[1, 2, 3]]
    assert [r.status for r in files.read_runs(spark, str(tmp_path / "runs")).collect()] == ["skipped"] * 2


# ---- a whole run --------------------------------------------------------------------------------------------------

def provider(spark, plan):
    page = "<article><p>" + "word " * 400 + "</p></article>"
    data = [("p", "arxiv", f"2601.0000{i}", f"Paper {i}", "An abstract. More.", f"https://arxiv.org/abs/2601.0000{i}", datetime(2026, 1, 2, i),
             ["cs.AI"], "arxiv", None, page if i % 2 else None) for i in range(6)]
    data.append(("q", "rss", "h", "Post", "Body", "https://b.org/post", datetime(2026, 1, 2), [], "blog", "My Feed", page))
    data.append(("q", "rss", "old", "Old", "Body", "https://b.org/old", datetime(2025, 1, 2), [], "blog", "My Feed", page))
    return spark.createDataFrame(data, "profile STRING, source STRING, item_id STRING, title STRING, abstract STRING, source_url STRING, "
                                 "published TIMESTAMP, categories ARRAY<STRING>, source_tag STRING, feed_name STRING, html STRING")


def scorer(rows_in: pd.DataFrame) -> pd.DataFrame:
    score = [float(4 + int(i[-1])) if i.startswith("2601") else 8.0 for i in rows_in.item_id]
    return pd.DataFrame({"item_id": rows_in.item_id, "score": score, "confidence": 0.5, "reason": "r", "filter_tags": [[]] * len(rows_in)})


def tier1(rows_in: pd.DataFrame) -> pd.Series:
    return rows_in.item_id.map(lambda _: '{"contributions":["c"],"method":"m","result":"r","relevance":"v"}')


def test_whole_run(spark):
    profiles = feeds.profiles_table(spark, [{"profile": "p"}, {"profile": "q"}, {"profile": "idle"}])
    existing = notes_frame(spark, []).drop("published", "source_tag")
    plan = run_plan.RunPlan(now=datetime(2026, 1, 3, tzinfo=timezone.utc))
    plugs = run_plan.Plugs(provider, scorer, tier1)
    result = run_plan.run(spark, plan, profiles, existing, plugs)
    notes = {r.source_url: r for r in result.notes.collect()}
    # scores 4..9: papers 3, 4 and 5 pass; 5 has a page and reaches full text, 4 has none
    assert sorted(notes) == ["https://arxiv.org/abs/2601.00003", "https://arxiv.org/abs/2601.00004", "https://arxiv.org/abs/2601.00005", "https://b.org/post"]
    assert notes["https://arxiv.org/abs/2601.00005"].full_text and "text:html" in notes["https://arxiv.org/abs/2601.00005"].tags
    assert TAGS.repair_needed in notes["https://arxiv.org/abs/2601.00004"].tags
    assert "text:abstract-only" in notes["https://arxiv.org/abs/2601.00003"].tags and not notes["https://arxiv.org/abs/2601.00003"].full_text
    post = notes["https://b.org/post"]
    assert "feed-slug:my-feed" in post.tags or post.version == 1
    assert post.tier1.method == "m" and post.path == "articles/blog/2026/01"
    ledger_rows = {r.profile: (r.sources_checked, r.ingested) for r in result.runs.collect()}
    assert ledger_rows == {"p": (6, 3), "q": (1, 1), "idle": (0, 0)}
    assert {(r.profile, r.fetched, r.created) for r in result.funnel.collect()} == {("p", 6, 3), ("q", 1, 1)}
    # a backfill over the same window finds everything in the store
    again = run_plan.RunPlan("backfill", window=(date(2026, 1, 2), date(2026, 1, 3)))
    assert again.skip_repair and again.skip_cache_hits and not again.notify
    kept = result.notes.checkpoint()
    repeat = run_plan.run(spark, again, profiles, kept, plugs)
    assert repeat.writes.count() == 0 and repeat.notes.count() == 4
    with pytest.raises(ValueError):
        run_plan.RunPlan("backfill")


def test_run_leaves_ledger_notices_and_edges(spark):
    profiles = feeds.profiles_table(spark, [{"profile": "p"}, {"profile": "q"}, {"profile": "idle"}])
    seen = spark.sparkContext.accumulator(0)

    def counting(rows_in):
        seen.add(1)
        assert rows_in.prompt.iloc[0].startswith("about")
        return scorer(rows_in)

    def shared(spark, plan):
        rows = provider(spark, plan).where("profile = 'p' and item_id in ('2601.00000', '2601.00005')")
        short = "<article><p>" + "word " * 140 + "</p></article>"
        post = provider(spark, plan).where("item_id = 'h'").withColumn("html", F.lit(short))
        # q brings the paper that p drops
        return rows.unionByName(post).unionByName(rows.where("item_id = '2601.00000'").withColumn("profile", F.lit("q")))

    def judge(rows_in):
        out = counting(rows_in)
        out.loc[rows_in.profile == "q", "score"] = 9.0
        return out

    earlier = spark.createDataFrame(
        [(f"{p}{i}", p, "scheduled", "completed", f"2026-01-0{i}T00:00:00+00:00", 5, 0) for p in ("p", "idle") for i in (1, 2)],
        "run_id STRING, profile STRING, kind STRING, status STRING, completed_at STRING, sources_checked INT, ingested INT")
    errors = spark.createDataFrame([("q", "rss", "timeout", "slow")], "profile STRING, source STRING, kind STRING, detail STRING")
    sinks = spark.createDataFrame([("d", "digest", "digest", True, ["scheduled"], None)],
                                  "name STRING, type STRING, event_mode STRING, enabled BOOLEAN, notify_on ARRAY<STRING>, min_score INT")
    past = run_plan.Past(earlier, None, "about {profile_description}", errors, sinks)
    plan = run_plan.RunPlan(now=datetime(2026, 1, 3, tzinfo=timezone.utc))
    existing = notes_frame(spark, []).drop("published", "source_tag")
    result = run_plan.run(spark, plan, profiles, existing, run_plan.Plugs(shared, judge), past=past,
                          finished=datetime(2026, 1, 3, 0, 1, tzinfo=timezone.utc))
    runs = {r.profile: r for r in result.runs.collect()}
    assert seen.value == 3  # one call per batch: p and q papers, q's post
    assert (runs["p"].ingested, runs["p"].outcome, runs["p"].duration_seconds) == (1, "success", 60.0)
    assert runs["q"].degraded_reasons == ["source_acquisition"] and runs["q"].degraded
    assert runs["idle"].outcome == "success" and runs["idle"].completed_at.startswith("2026-01-03T00:01")
    assert {(r.profile, r.source, r.filter_drop, r.created) for r in result.funnel.collect()} == {
        ("p", "arxiv", 1, 1), ("q", "arxiv", 0, 1), ("q", "rss", 0, 1)}
    assert {(r.profile, r.sink) for r in result.notices.collect()} == {("p", "d"), ("q", "d"), ("idle", "d")}
    assert result.edges.count() == 0
    notes = {r.source_url: r for r in result.notes.collect()}
    assert "word word" in notes["https://b.org/post"].full_text  # 700 characters are enough for an article
    # a paper without a page gets its text from the plugged extractor
    pdf = run_plan.run(spark, plan, profiles, existing, run_plan.Plugs(
        provider, scorer, tier2=lambda rows_in: rows_in.item_id.map(lambda _: "from the document")))
    assert pdf.notes.where("source_url = 'https://arxiv.org/abs/2601.00004'").first().full_text == "from the document"


def test_prompts(spark):
    profiles = feeds.profiles_table(spark, [{"profile": "p", "description": "D"}, {"profile": "q"}])
    rejected = spark.createDataFrame([("p", "Bad one", 1), ("p", "Newer", 2)], "profile STRING, title STRING, pos INT")
    got = {r.profile: r.prompt for r in run_plan.feedback_prompts(
        profiles, rejected, "{profile_description}|{negative_examples}|{min_score_in_results}").collect()}
    assert got == {"p": 'D|- "Newer" (rejected)\n- "Bad one" (rejected)|7', "q": "||7"}
    assert run_plan.feedback_prompts(profiles, rejected, "{oops} {profile_description}").first().prompt == "{oops} {profile_description}"


def test_links(spark):
    notes = spark.createDataFrame([("a", "https://arxiv.org/abs/2601.00001", ["arXiv:2601.00002"]), ("b", "https://arxiv.org/abs/2601.00002", None)],
                                  "note_id STRING, source_url STRING, builds_on ARRAY<STRING>")
    vectors = spark.createDataFrame([("p", "a", [1.0, 0.0]), ("p", "b", [1.0, 0.1])], "profile STRING, id STRING, vector ARRAY<DOUBLE>")
    assert {(r.type, r.source_note_id, r.target_note_id) for r in run_plan.link(notes, vectors).collect()} == {
        ("builds_on", "a", "b"), ("related_to", "a", "b"), ("related_to", "b", "a")}


def test_upsert_stream_writes_notes_once(spark, tmp_path):
    """A store is laid out as the base at once, without a delta that says the same; repeated ids stay one note."""
    fields = ["note_id", "version", "source_url", "slug", "full_text"]
    rows = spark.createDataFrame([("n1", 1, "https://a.com/1", "one", "x"), ("n1", 1, "https://a.com/1", "one", "x"),
                                  ("n2", 1, "", "two", "y")], fields)
    blank = spark.createDataFrame([], NOTES)
    notes = rows.select(*[(F.col(c) if c in fields else F.lit(None)).cast(kind).alias(c) for c, kind in blank.dtypes])
    upserts.seed(notes, str(tmp_path))
    table = upserts.NoteTable(spark, str(tmp_path))
    assert table.parts() == (-1, []) and not (tmp_path / "delta").exists()
    assert sorted((r.note_id, r.full_text) for r in table.read().collect()) == [("n1", "x"), ("n2", "y")]
