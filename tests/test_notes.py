from __future__ import annotations

import random
from datetime import datetime

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gleaner.operators import cascade, graph, repair, scoring, store
from gleaner.schemas import NOTES, TIER3
from gleaner.vocabulary import TAGS

# ---- scoring ------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def candidates(spark):
    rows = [("p", "hot" if i % 3 else "cold", f"i{i:03d}") for i in range(90)] + [("q", "x", "i000")]
    return spark.createDataFrame(rows, "profile STRING, source STRING, item_id STRING")


def test_batches_are_contiguous(candidates):
    rows = scoring.score_batches(candidates, size=25).collect()
    hot = sorted((r.item_id, r.batch_id) for r in rows if r.source == "hot" and r.profile == "p")
    assert [b for _, b in hot] == [i // 25 for i in range(60)]
    assert {r.batch_id for r in scoring.score_batches(candidates, size=0).where("source = 'x'").collect()} == {0}


def good_scorer(rows: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame({"item_id": list(rows.item_id) + ["alien", rows.item_id.iloc[0]], "score": 7.0, "confidence": 0.7,
                        "reason": "r", "filter_tags": [list("abcdefg")] * (len(rows) + 2)})
    out.loc[len(out) - 1, "score"] = 9.0
    return out


def test_scorer_plug(candidates):
    got = {(r.profile, r.item_id): r for r in scoring.score_candidates(candidates, good_scorer).collect()}
    assert len(got) == 91 and got["p", "i001"].score == 9 and got["p", "i002"].score == 7
    assert got["p", "i002"].filter_tags == list("abcde")
    assert scoring.score_candidates(candidates, None).count() == 0


def test_failed_or_invalid_batch_poisons_its_source(candidates):
    def fails(rows):
        if (rows.source == "hot").any() and "i089" in set(rows.item_id):
            raise RuntimeError("down")
        return good_scorer(rows)

    def invalid(rows):
        out = good_scorer(rows)
        if (rows.source == "hot").any():
            out.loc[0, "score"] = 11.0
        return out

    for scorer in (fails, invalid):
        left = scoring.score_candidates(candidates, scorer).join(candidates, ["profile", "item_id"])
        assert {r.source for r in left.select("source").distinct().collect()} == {"cold", "x"}


def test_retry_recovers(candidates, tmp_path):
    marker = str(tmp_path / "tried")

    def flaky(rows):
        import os

        name = f"{marker}-{rows.profile.iloc[0]}-{rows.source.iloc[0]}-{rows.item_id.iloc[0]}"
        if not os.path.exists(name):
            open(name, "w").close()
            raise RuntimeError("once")
        return good_scorer(rows)

    assert scoring.score_candidates(candidates, flaky, retries=1).count() == 91


def test_responses(spark):
    rows = [("p", "s", 0, '{"results":[{"id":"a","score":5,"tags":[],"reason":"r"},{"id":"a","score":6,"tags":[],"reason":"r"}]}'),
            ("p", "s", 1, "broken")]
    df = scoring.responses_to_scores(spark.createDataFrame(rows, "profile STRING, source STRING, batch_id INT, content STRING"))
    assert {(r.batch_id, r.parsed) for r in df.collect()} == {(0, True), (1, False)}
    best = scoring.last_wins(df.where("item_id IS NOT NULL"), ["profile", "item_id"]).collect()
    assert [r.score for r in best] == [6.0]


def test_column_scorer_and_gate(spark):
    df = spark.createDataFrame([("a", 7), ("b", 6), ("c", None)], "item_id STRING, n INT")
    got = {r.item_id: (r.decision, r.drop_reason) for r in scoring.relevance_gate(scoring.score_with_column(df, F.col("n"))).collect()}
    assert got == {"a": ("pass", None), "b": ("drop", "below_relevance"), "c": ("drop", "not_returned_by_filter")}


# ---- cascade ------------------------------------------------------------------------------------------------------

def test_extraction_cascade(spark):
    long_page = "<html><body><nav>menu</nav><article><p>" + "word " * 300 + "</p><script>x()</script></article></body></html>"
    rows = [("a", long_page, None), ("b", "<p>short</p>", "pdf text"), ("c", "<p>short</p>", " "), ("d", None, None)]
    df = cascade.extract_text(spark.createDataFrame(rows, "id STRING, html STRING, pdf STRING"), pdf_text="pdf")
    got = {r.id: r for r in df.collect()}
    assert got["a"].text_tag == "text:html" and "menu" not in got["a"].extracted_text and "x()" not in got["a"].extracted_text
    assert (got["b"].text_tag, got["b"].extracted_text) == ("text:pdf", "pdf text")
    assert (got["c"].text_tag, got["c"].extract_problem) == ("text:abstract-only", "too_short")
    assert got["d"].extract_problem == "no_html"


def test_models_run_on_gated_rows_only(spark):
    df = spark.createDataFrame([(i, i % 2 == 0) for i in range(6)], "id INT, run_tier1 BOOLEAN")

    def model(rows):
        assert (rows.id % 2 == 0).all()
        return rows.id.map(lambda i: '{"contributions":["c"],"method":"m","result":"r","relevance":"v"}' if i else "bad")

    got = {r.id: r.tier1 is not None for r in cascade.tier1_enrich(df, model).collect()}
    assert got == {0: False, 2: True, 4: True, 1: False, 3: False, 5: False}
    deep = cascade.tier3_extract(df.withColumnRenamed("run_tier1", "run_tier3"), lambda rows: rows.id.map(lambda _: '{"claims":["x"]}'))
    assert deep.where("tier3 IS NOT NULL").count() == 3
    texts = cascade.tier2_extract(df.withColumnRenamed("run_tier1", "run_tier2"), lambda rows: rows.id.map(lambda i: "pdf" if i else " "))
    assert {r.id: r.text_tag for r in texts.collect() if r.id % 2 == 0} == {0: "text:abstract-only", 2: "text:pdf", 4: "text:pdf"}


def test_terminal_flag_only_where_the_tier_would_run(spark):
    rows = [(8, False, 3, 0), (7, False, 3, 0), (9, True, 0, 3), (9, False, 3, 3)]
    gates = cascade.cascade_gates(F.col("s"), F.col("t"), F.col("a"), F.col("b"))
    df = spark.createDataFrame(rows, "s INT, t BOOLEAN, a INT, b INT").withColumns(gates).withColumn("has_text", F.col("t"))
    for c in ("tier2_ok", "tier1_ok", "tier3_ok"):
        df = df.withColumn(c, F.lit(True))
    got = [(r.tier2_terminal, r.tier3_terminal, r.full_text_kept) for r in cascade.cascade_outcome(df).collect()]
    assert got == [(True, False, False), (False, False, False), (False, True, True), (True, False, False)]


# ---- store --------------------------------------------------------------------------------------------------------

def test_collision_kinds(spark):
    rows = [("https://arxiv.org/abs/1.1", ["arxiv-id:1.1"], None, "b", "duplicate"), ("u", ["x"], "u", "b", "duplicate"),
            ("u", [], "", " ", "reclaimable"), ("u", None, None, None, "reclaimable"), ("u", [], "", "body", "distinct"),
            ("u", ["x"], "", "", "distinct"), ("https://arxiv.org/abs/1.1", ["arxiv-id:1.10"], "w", "", "distinct")]
    df = spark.createDataFrame(rows, "inc STRING, tags ARRAY<STRING>, url STRING, body STRING, want STRING")
    for r in df.withColumn("got", store.collision_kind(F.col("inc"), F.col("tags"), F.col("url"), F.col("body"))).collect():
        assert r.got == r.want, r


def note(title, url, **kw):
    base = {"source_url": url, "title": title, "tags": ["profile:p", "ingested-by:gleaner"], "relevance": [], "confidence": 0.5,
            "user_notes": None, "version": 1, "note_id": f"n-{title}", "slug": title.lower().replace(" ", "-")}
    return {**base, **kw}


def incoming_rows(spark, rows):
    schema = "profile STRING, item_id STRING, title STRING, source_url STRING, score INT, reason STRING, tags ARRAY<STRING>, user_notes STRING"
    return spark.createDataFrame([(p, i, t, u, s, "r", [f"profile:{p}", "ingested-by:gleaner"], None) for p, i, t, u, s in rows], schema)


def test_upsert(spark):
    existing = spark.createDataFrame([
        note("Known", "https://e.com/a", user_notes="## User Notes\nmine"), note("Taken", "https://e.com/t"),
        note("Residue", "", tags=[])], NOTES)
    new = incoming_rows(spark, [
        ("p", "1", "Known", "https://E.com/a/?utm_x=1", 9), ("q", "2", "Known again", "https://e.com/a", 6),
        ("p", "3", "Taken", "https://other.org/x", 8), ("p", "4", "Residue", "https://e.com/r", 7),
        ("p", "5", "", "https://e.com/z", 7), ("p", "6", "Fresh", "https://e.com/f", 7), ("p", "7", "Fresh", "https://e.com/g", 7)])
    notes, results = store.upsert_notes(existing, new)
    got = {r.source_url: r for r in notes.collect()}
    known = got["https://e.com/a"]
    assert known.version == 2 and known.note_id == "n-Known" and known.user_notes == "## User Notes\nmine"
    assert {(e.profile, e.score) for e in known.relevance} == {("p", 9), ("q", 6)} and known.confidence == 0.9
    assert got["https://other.org/x"].title == "Taken [other.org]" and got["https://e.com/r"].title == "Residue"
    assert got["https://e.com/g"].title == "Fresh [e.com]" and got["https://e.com/f"].title == "Fresh"
    assert "" not in got and None not in got and len(got) == 6
    status = {r.item_id: r.status for r in results.collect()}
    assert status == {"1": "updated", "2": "updated", "3": "created", "4": "created", "5": "invalid_input", "6": "created", "7": "created"}


def test_upsert_keeps_content_columns(spark):
    existing = spark.createDataFrame([note("Known", "https://e.com/a")], NOTES).withColumn("full_text", F.lit("old")).withColumn(
        "archive_path", F.lit("kept.pdf"))
    new = incoming_rows(spark, [("p", "1", "Known", "https://e.com/a", 9), ("p", "2", "New", "https://e.com/b", 9)]).withColumn(
        "full_text", F.concat(F.lit("text "), "item_id"))
    got = {r.title: (r.full_text, r.archive_path) for r in store.upsert_notes(existing, new)[0].collect()}
    assert got == {"Known": ("text 1", "kept.pdf"), "New": ("text 2", None)}


def test_conflict_merge(spark):
    pending = spark.createDataFrame([("a", 1, ["full-text", "source:x"], "edit", "mine"), ("b", 4, ["x"], "edit", "u")],
                                    "note_id STRING, expected_version BIGINT, tags ARRAY<STRING>, full_text STRING, user_notes STRING")
    stored = spark.createDataFrame([("a", 2, ["keep", "source:old"], "theirs"), ("b", 4, ["y"], "v")],
                                   "note_id STRING, version BIGINT, tags ARRAY<STRING>, user_notes STRING")
    got = {r.note_id: r for r in store.sweep_conflict_merge(pending, stored).collect()}
    assert got["a"].conflict and got["a"].tags == ["full-text", "source:x", "keep"] and got["a"].user_notes == "theirs"
    assert got["a"].full_text == "edit" and got["a"].expected_version == 2
    assert not got["b"].conflict and got["b"].tags == ["x"] and got["b"].user_notes == "u"


# ---- repair -------------------------------------------------------------------------------------------------------

def repair_note(spark, tags, path=None, score=9, repair_counts=None, **kw):
    row = {"note_id": "n", "version": 3, "title": "t", "slug": "t", "path": "papers/arxiv/2026/01", "source_url": "u", "tags": tags,
           "confidence": 0.9, "archive_path": path, "summary": "s", "full_text": None, "tier1": None, "tier3": None,
           "relevance": [("p", score, "r")], "repair": repair_counts, "user_notes": "", "updated_at": datetime(2026, 1, 1), **kw}
    names = [f.name for f in spark.createDataFrame([], NOTES).schema]
    return spark.createDataFrame([tuple(row[n] for n in names)], NOTES)


BASE = ["profile:p", "source:arxiv", TAGS.ingested_by, TAGS.repair_needed]


def outcome(**cols):
    def hook(df):
        spark = df.sparkSession
        schema = ", ".join(f"{k} {TIER3 if k == 'tier3' else 'STRING'}" for k in cols)
        return df.select("note_id").crossJoin(spark.createDataFrame([tuple(cols.values())], schema).hint("broadcast"))

    return hook


def test_sweep_completes_a_note(spark):
    note_row = repair_note(spark, [*BASE, "text:abstract-only", TAGS.archive_missing])
    r = repair.repair_sweep(
        note_row, archive_download=outcome(path="a/b.pdf", failure_stage=None, error=None),
        re_extract=outcome(outcome="upgrade", text_tag="text:pdf"),
        tier2_enrich=outcome(full_text="body", failure_stage=None, error=None),
        tier3_extract=outcome(tier3=(["c"], [], [], [], []), failure_stage=None, error=None)).first()
    assert set(r.tags) == {"profile:p", "source:arxiv", TAGS.ingested_by, "text:pdf", "full-text", TAGS.deep_extracted}
    assert (r.archive_path, r.full_text, r.tier3.claims, r.version) == ("a/b.pdf", "body", ["c"], 4)


def test_sweep_counts_failures_and_flips_once(spark):
    counts = (2, "parse", "old", 0, "", "", 0, "", "")
    note_row = repair_note(spark, [*BASE, "text:html"], path="x.pdf", repair_counts=counts)
    r = repair.repair_sweep(note_row, tier2_enrich=outcome(full_text=None, failure_stage="validate", error="a\nb"),
                            tier3_extract=outcome(tier3=None, failure_stage="timeout", error="later")).first()
    assert TAGS.stage_terminal("tier2") in r.tags and TAGS.stage_terminal("tier3") not in r.tags
    assert (r.repair.tier2_attempts, r.repair.tier2_last_stage, r.repair.tier2_last_error, r.repair.tier3_attempts) == (3, "validate", "a b", 0)
    assert TAGS.repair_needed in r.tags


def test_sweep_leaves_oversize_notes_alone(spark):
    note_row = repair_note(spark, [*BASE, "text:html"], path="x.pdf", score=1, summary="z" * 50)
    r = repair.repair_sweep(note_row, content_limit=10).first()
    assert (r.swept, r.version, r.tags, r.updated_at) == (False, 3, [*BASE, "text:html"], datetime(2026, 1, 1))
    assert TAGS.repair_needed not in repair.repair_sweep(note_row).first().tags


def test_sweep_respects_rejections(spark):
    note_row = repair_note(spark, [*BASE, "profile:q", TAGS.rejected_prefix + "q", "text:html"], path="x", score=1)
    assert "profile:q" not in repair.repair_sweep(note_row).first().tags


def test_queue_and_retry_args(spark):
    rows = [("a", [*BASE], 2), ("b", [*BASE], 1), ("c", ["profile:p"], 0), ("d", [TAGS.repair_needed, "profile:q"], 0)]
    notes = spark.createDataFrame([(i, t, datetime(2026, 1, 1 + d)) for i, t, d in rows], "note_id STRING, tags ARRAY<STRING>, updated_at TIMESTAMP")
    assert [r.note_id for r in repair.repair_queue(notes, "p").collect()] == ["b", "a"]
    assert [r.note_id for r in repair.repair_queue(notes, "p", 1).collect()] == ["b"]
    rows = [("a", ["source:arxiv", "arxiv-id:2601.1"], "papers/arxiv/2026/01"), ("b", ["source:blog"], "articles/blog/2026/01"),
            ("c", ["source:arxiv"], "papers/arxiv/2026/01"), ("d", ["source:arxiv", "arxiv-id:1"], "elsewhere")]
    args = repair.archive_retry_args(spark.createDataFrame(rows, "note_id STRING, tags ARRAY<STRING>, path STRING")).collect()
    assert {r.note_id: r.problem for r in args} == {"a": None, "b": "unsupported_source", "c": "resolve", "d": "resolve"}


def test_reextraction(spark):
    df = spark.createDataFrame([("upgrade",), ("terminal",), ("transient",)], "o STRING")
    tags = F.array(F.lit("a"), F.lit("text:abstract-only"))
    got = [r.t for r in df.select(repair.apply_reextraction(tags, F.col("o"), F.lit("text:html")).alias("t")).collect()]
    assert got == [["a", "text:html"], ["a", "text:abstract-only", TAGS.text_terminal], ["a", "text:abstract-only"]]


# ---- links --------------------------------------------------------------------------------------------------------

def brute_force(vectors, k, threshold):
    want = {}
    for p, i, v in vectors:
        scored = []
        for q, j, w in vectors:
            if p == q and i != j:
                s = round(float(np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w))), 6)
                if s >= threshold:
                    scored.append((-s, j))
        want[i] = [j for _, j in sorted(scored)[:k]]
    return {i: w for i, w in want.items() if w}


@pytest.mark.parametrize(("pivots", "block", "threshold"), [(1, 10_000, 0.3), (6, 7, 0.3), (12, 25, 0.8)])
def test_related_equals_brute_force(spark, pivots, block, threshold):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 8))
    vectors = [("hot" if i % 4 else "p", i, (centres[i % 5] + 0.5 * rng.normal(size=8)).tolist()) for i in range(120)]
    # a large group of equal vectors
    vectors += [("hot", 200 + i, vectors[1][2]) for i in range(60)]
    random.Random(1).shuffle(vectors)
    df = spark.createDataFrame(vectors, "profile STRING, id INT, vector ARRAY<DOUBLE>")
    rows = graph.related_to(df, df, 5, threshold, pivots=pivots, block_rows=block).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.source_id, r["rank"])):
        got.setdefault(r.source_id, []).append(r.target_id)
    assert got == brute_force(vectors, 5, threshold)


@pytest.mark.parametrize("call_rows", [1, 10, 1024])
def test_batches_share_a_python_call(spark, monkeypatch, call_rows):
    """Spark groups follow the rows, not the batches; the scorer still gets one batch a call, in order."""
    monkeypatch.setattr(scoring, "CALL_ROWS", call_rows)
    items = spark.range(3000).selectExpr("'p' as profile", "'s' as source", "lpad(id, 6, '0') as item_id")
    calls = spark.sparkContext.accumulator(0)

    def scorer(rows):
        calls.add(1)
        assert len(rows) <= 4 and rows.item_id.is_monotonic_increasing and "_call" not in rows and rows.index[0] == 0
        return pd.DataFrame({"item_id": rows.item_id, "score": 5.0, "confidence": 0.5, "reason": "r", "filter_tags": [["t"]] * len(rows)})

    out = scoring.score_candidates(items, scorer, size=4)
    assert calls.value == 750 and out.count() == 3000 and calls.value == 750
    assert out.where("batch_id = 749").count() == 4


def test_related_index_misses_nothing(spark):
    """Random vectors at a low threshold: what the index does not visit is compared too."""
    rng = np.random.default_rng(5)
    data = [("p", i, [float(x) for x in rng.normal(size=16)]) for i in range(600)]
    df = spark.createDataFrame(data, "profile STRING, id INT, vector ARRAY<DOUBLE>")
    got = {}
    for r in graph.related_index(df, df, 5, 0.3, visits=1, shortlist=8, block_rows=100).collect():
        got.setdefault(r.source_id, {})[r["rank"]] = r.target_id
    assert {i: [t for _, t in sorted(w.items())] for i, w in got.items()} == brute_force(data, 5, 0.3)


def test_tiles_are_sent_whole(spark):
    """Small cells share tiles: pairs of tiles follow the rows, not rows times cells."""
    rng = np.random.default_rng(6)
    rows = [("p", i, [float(x) for x in rng.normal(size=8)]) for i in range(400)]
    df = spark.createDataFrame(rows, "profile STRING, id INT, vector ARRAY<DOUBLE>")
    firsts, _ = graph._distinct_vectors(df, 6)
    centres = np.array([v for _, _, v in rows[:50]])
    tiled = graph._tiled(firsts, centres / np.linalg.norm(centres, axis=1, keepdims=True), 100)
    sizes = [r["count"] for r in tiled.groupBy("profile", "tile").count().collect()]
    assert len(sizes) <= 5 and sum(sizes) == 400 and tiled.select("ref").distinct().count() == 400


def test_related_for_incoming_rows(spark):
    notes = spark.createDataFrame([("p", 1, [1.0, 0.0]), ("p", 2, [0.9, 0.1]), ("q", 3, [1.0, 0.0])], "profile STRING, id INT, vector ARRAY<DOUBLE>")
    asked = spark.createDataFrame([("p", 9, [1.0, 0.01])], "profile STRING, id INT, vector ARRAY<DOUBLE>")
    got = graph.related_to(asked, notes, 5, 0.75).collect()
    assert [(r.source_id, r.target_id) for r in sorted(got, key=lambda r: r["rank"])] == [(9, 1), (9, 2)]
    assert graph.related_edges(graph.related_to(asked, notes, 5, 0.75)).first().type == "related_to"
    assert graph.related_to(asked, notes.limit(0)).count() == 0


def test_references(spark):
    rows = [("a", "https://arxiv.org/abs/2601.00001", ["X (arXiv:2601.00002)", "none", "arXiv:2601.00002v2", "arXiv:2601.99999"]),
            ("b", "https://arxiv.org/abs/2601.00002", [])]
    notes = spark.createDataFrame(rows, "note_id STRING, source_url STRING, builds_on ARRAY<STRING>")
    edges = graph.resolve_builds_on(notes)
    assert [(r.source_note_id, r.target_note_id) for r in edges.collect()] == [("a", "b")]
    assert {(r.arxiv_id, r.unresolved_reason) for r in graph.unresolved_refs(notes).collect()} == {
        ("2601.00002v2", "versioned"), ("2601.99999", "unknown")}
    newer = edges.withColumn("evidence", F.struct(F.lit("k").alias("kind"), F.lit(0.5).alias("score")))
    assert [r.evidence.score for r in graph.upsert_edges(edges, newer).collect()] == [0.5]


# ---- upserts lose nothing -----------------------------------------------------------------------------------------

def stored_notes(spark, *rows):
    names = [f.name for f in spark.createDataFrame([], NOTES).schema]
    blank = dict.fromkeys(names)
    return spark.createDataFrame([tuple({**blank, **r}[n] for n in names) for r in rows], NOTES)


def test_upsert_keeps_notes_that_say_something(spark):
    existing = stored_notes(spark, note("hold", "", tags=[], full_text="a text"), note("hull", "", tags=[], tier3=(["c"], [], [], [], [])),
                            note("void", "", tags=[]))
    new = incoming_rows(spark, [("p", str(i), t, f"https://e{i}.com/x", 7) for i, t in enumerate(["hold", "hull", "void"])])
    notes, results = store.upsert_notes(existing, new)
    got = {r.note_id: r.title for r in notes.collect()}
    assert got["n-hold"] == "hold" and got["n-hull"] == "hull" and "n-void" not in got and len(got) == 5
    assert {r.title for r in notes.where("source_url <> ''").collect()} == {"hold [e0.com]", "hull [e1.com]", "void"}
    assert {r.status for r in results.collect()} == {"created"}


def test_upsert_keeps_title_and_slug_of_stored_notes(spark):
    existing = stored_notes(spark, note("Same", "https://a.com/1"), note("Same [b.com]", "https://b.com/1", slug="same-b-com"))
    notes = store.upsert_notes(existing, incoming_rows(spark, [("p", "1", "Same", "https://b.com/1", 7)]))[0].collect()
    assert sorted((r.title, r.slug) for r in notes) == [("Same", "same"), ("Same [b.com]", "same-b-com")]


def test_last_row_of_a_profile_wins_and_each_row_has_a_status(spark):
    new = incoming_rows(spark, [("p", "1", "First", "https://e.com/a", 3), ("p", "2", "Second", "https://e.com/a", 9),
                                ("q", "3", "Third", "https://e.com/a", 5)]).withColumn("summary", F.concat(F.lit("s"), "item_id"))
    notes, results = store.upsert_notes(stored_notes(spark), new)
    r = notes.first()
    assert (r.title, r.summary, {(e.profile, e.score) for e in r.relevance}) == ("First", "s3", {("p", 9), ("q", 5)})
    assert sorted((x.item_id, x.profile, x.status) for x in results.collect()) == [
        ("1", "p", "created"), ("2", "p", "updated"), ("3", "q", "updated")]


def test_stale_versions(spark):
    existing = stored_notes(spark, note("A", "https://e.com/a", version=4), note("B", "https://e.com/b", version=4))
    new = incoming_rows(spark, [("p", "1", "A", "https://e.com/a", 7), ("p", "2", "B", "https://e.com/b", 7)]).withColumn(
        "expected_version", F.when(F.col("item_id") == "1", 3).otherwise(4))
    notes, results = store.upsert_notes(existing, new, retry_conflicts=False)
    assert {r.item_id: r.status for r in results.collect()} == {"1": "version_conflict", "2": "updated"}
    assert {r.title: r.version for r in notes.collect()} == {"A": 4, "B": 5}
    notes, results = store.upsert_notes(existing, new)
    assert {r.status for r in results.collect()} == {"updated"} and {r.version for r in notes.collect()} == {5}


def test_upsert_applies_the_size_ladder(spark):
    deep = (["c" * 100], [], [], [], [])
    existing = stored_notes(spark, note("A", "https://e.com/a"), note("B", "https://e.com/b", summary="old"))
    rows = [("p", "1", "A", "https://e.com/a", 7), ("p", "2", "B", "https://e.com/b", 7), ("p", "3", "C", "https://e.com/c", 7),
            ("p", "4", "D", "https://e.com/d", 7), ("p", "5", "E", "https://e.com/e", 7)]
    said = spark.createDataFrame([("1", "s", "f" * 50, deep), ("2", "s" * 500, None, None), ("3", "s", "f" * 300, None), ("4", "s", None, None),
                                  ("5", "s", None, (["c" * 400], [], [], [], []))], f"item_id STRING, summary STRING, full_text STRING, tier3 {TIER3}")
    notes, results = store.upsert_notes(existing, incoming_rows(spark, rows).join(said, "item_id"), content_limit=150)
    got = {r.title: r for r in notes.collect()}
    assert got["A"].full_text is None and got["A"].tier3 is None and TAGS.repair_needed in got["A"].tags
    assert (got["B"].summary, got["B"].version) == ("old", 1)
    assert got["C"].full_text is None and got["D"].version == 1 and "E" not in got
    assert {r.item_id: r.status for r in results.collect()} == {
        "1": "updated", "2": "content_too_large_skipped", "3": "created", "4": "created", "5": "content_too_large_skipped"}


def test_related_index_against_the_exact_form(spark, monkeypatch):
    """2,400 notes in clusters, some of them equal: nine in ten related notes are found, and their scores are exact."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(150, 32))
    data = []
    for i in range(2400):
        v = centres[i % 150] + rng.normal(size=32) * rng.choice([0.3, 0.6, 0.9])
        data.append(("p" if i % 4 else "q", i, [float(x) for x in v]))
    data += [(p, i + 10_000, v) for p, i, v in data[:20]]
    notes = spark.createDataFrame(data, "profile STRING, id LONG, vector ARRAY<DOUBLE>")
    exact = {(r.source_id, r.target_id): (r.score, r["rank"]) for r in graph.related_to(notes, notes, threshold=0.75).collect()}
    found = {(r.source_id, r.target_id): r.score for r in graph.related_index(
        notes, notes, threshold=0.75, visits=6, shortlist=64, block_rows=500).collect()}
    assert len(exact) > 3000 and len(found.keys() & exact.keys()) >= 0.9 * len(exact)
    assert all(abs(found[k] - exact[k][0]) <= 1e-6 for k in found.keys() & exact.keys())
    few = notes.where("id % 10 = 0")
    some = graph.related_index(few, notes, threshold=0.75).collect()
    assert some and all(r.source_id % 10 == 0 and r.source_id != r.target_id for r in some)
    assert graph.related_index(notes.limit(0), notes.limit(0)).collect() == []
