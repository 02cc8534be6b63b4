from __future__ import annotations

import unicodedata
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gleaner.functions import dates, markdown, payloads
from gleaner.functions import tags as tg
from gleaner.functions import text as tx
from gleaner.functions import urls as ux
from gleaner.schemas import REPAIR
from gleaner.vocabulary import TagVocabulary

V = None  # the column `v`, once there is a session


@pytest.fixture(autouse=True, scope="module")
def column(spark):
    global V
    V = F.col("v")


def test_normalise_url(spark, evaluate):
    cases = {
        "HTTPS://Example.COM/Path/": "https://example.com/Path",
        "https://example.com:443/a": "https://example.com/a",
        "http://example.com:80/": "http://example.com",
        "http://example.com:8080/a//": "http://example.com:8080/a",
        "https://example.com:80/a": "https://example.com:80/a",
        "https://user:pw@example.com/a": "https://example.com/a",
        "https://example.com/a;v=1": "https://example.com/a",
        "https://example.com/a;x/b": "https://example.com/a;x/b",
        "https://example.com/?utm_source=x&b=2&a=1&b=3&&fbclid=9": "https://example.com?b=2&a=1&b=3",
        "https://example.com/a?ref=1&refer=2&q=%20": "https://example.com/a?refer=2&q=%20",
        "https://example.com/a?empty=&x": "https://example.com/a?empty=&x",
        "https://example.com/a?gclid=1#Frag?ment": "https://example.com/a#Frag?ment",
        "https://[2001:DB8::1]:443/x": "https://2001:db8::1/x",
        "http://under_score.example.com/": "http://under_score.example.com",
        "relative/path/": "relative/path",
        "//Host.org/p/?a": "//host.org/p?a",
        "mailto:Someone": "mailto:Someone",
        "https://example.com?utm_a=1&&x=1&reference=2&utm_b&ref": "https://example.com?x=1&reference=2",
        "https://example.com/a?x=utm_y#utm_z=1": "https://example.com/a?x=utm_y#utm_z=1",
        "https://example.com/a?#": "https://example.com/a",
        "https://example.com:0443/a?next=https://o.org/?ref=1": "https://example.com/a?next=https://o.org/?ref=1",
    }
    assert evaluate(list(cases), ux.normalise_url(V)) == list(cases.values())
    staged = ux.with_normalised_url(spark.createDataFrame([(c,) for c in cases], "v STRING"), "v", "n", "h")
    assert {r.v: r.n for r in staged.collect()} == cases and staged.columns == ["v", "n", "h"]


def test_url_hash_is_stable_over_equal_urls(evaluate):
    a, b, c = evaluate(["https://x.org/a/?utm_x=1", "HTTPS://X.org/a", "https://x.org/b"], ux.url_hash(V))
    assert a == b != c and len(a) == 10


def test_url_block_reason(evaluate):
    cases = {
        "https://example.com": None, "ftp://example.com": "scheme", "javascript:x": "scheme",
        "http://localhost:1": "loopback", "http://127.9.9.9": "loopback", "http://[::1]/": "loopback",
        "http://10.0.0.1": "private", "http://172.16.0.1": "private", "http://172.32.0.1": None,
        "http://192.168.1.1": "private", "http://[fd00::1]/": "private", "http://169.254.169.254/": "link_local",
        "http://[fe80::1]/": "link_local", "http://224.0.0.1": "multicast", "http://0.0.0.0": "reserved",
        "https:///nohost": "no_host",
    }
    assert evaluate(list(cases), ux.url_block_reason(V)) == list(cases.values())


def test_arxiv_ids(evaluate):
    assert evaluate(["http://arxiv.org/abs/2601.00001v3", "2601.00001", "https://arxiv.org/abs/cs/0101001v1"],
                    ux.arxiv_id(V)) == ["2601.00001", "2601.00001", "cs/0101001"]
    assert evaluate(["https://arxiv.org/abs/2601.1v2?x=1", "https://e.com"], ux.arxiv_id_from_url(V)) == ["2601.1v2", None]
    refs = evaluate(["Tidal Graphs (arXiv:2507.00321)", "arXiv:2412.12345", "Bar arXiv:2412.12345v2 x", "no ref"], ux.arxiv_ref(V))
    assert [r and tuple(r) for r in refs] == [
        ("Tidal Graphs", "2507.00321"), ("2412.12345", "2412.12345"), ("Bar", "2412.12345v2"), None]
    assert evaluate(["https://arxiv.org/abs/2601.1", "https://Blog.x.org:1/p"], ux.slug_suffix(V)) == [
        " [arXiv 2601.1]", " [blog.x.org]"]


def python_slug(name):
    text = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode().lower()
    out, gap = "", False
    for ch in text:
        if ch.isalnum():
            out, gap = out + ("-" if gap and out else "") + ch, False
        else:
            gap = True
    return out[:40].rstrip("-")


def test_slugify(evaluate):
    names = ["Héllo Wörld", "  --A  b--  ", "Straße", "", "日本", "x" * 60, "a" * 39 + " b", "Ĳssel ½ ﬁ™", "naïve café"]
    latin = [n for n in names if "ﬁ" not in n]
    assert evaluate(latin, tx.slugify(V)) == [python_slug(n) for n in latin]
    assert evaluate(names, tx.slugify_any(V)) == [python_slug(n) for n in names]
    assert evaluate(["a-b", "a--b", "-a", "A", "a" * 41, ""], tx.is_valid_slug(V)) == [True, False, False, False, False, False]
    assert evaluate(["a/b", "../x", "/abs", "a/../b", "a..b"], tx.is_safe_item_id(V)) == [True, False, False, False, True]


@pytest.mark.parametrize(("text", "wanted"), [
    ("We show it. Then more.", "We show it"), ("Mr. Smith did that. Yes.", "Mr. Smith did that"),
    ("Use e.g. this one! Now", "Use e.g. this one"), ("Is it so? Yes", "Is it so"), ("No end here", "No end here"),
    ("Ends here.", "Ends here"), ("Version 2. of it.", "Version 2. of it"), ("  \n padded ends.\nnext", "padded ends"),
    ("y" * 300, "y" * 200),
])
def test_first_sentence(evaluate, text, wanted):
    assert evaluate([text], tx.first_sentence(V)) == [wanted]


def test_queries(evaluate):
    q = tx.dedup_query(V, F.col("w"))
    assert evaluate([(" T ", "One two. Three"), ("T", "  "), ("  ", "x")], q, "v STRING, w STRING") == ["T One two", "T", None]
    r = tx.retrieve_query(V, F.col("w"))
    rows = [("Title", [" a ", "", "b", "late"]), ("T\n x", None)]
    assert evaluate(rows, r, "v STRING, w ARRAY<STRING>") == ["Title | a | b", "T x"]


def test_small_text_rules(evaluate):
    assert evaluate(["a\r\nb \t c", "x" * 400], tx.one_line(V)) == ["a b c", "x" * 300]
    assert evaluate(["HTTP 404 for x", "oversize: 9", "odd", "", None, ": x"], tx.download_kind(V)) == [
        "http", "oversize", "odd", "archive_failed", "archive_failed", "archive_failed"]
    assert evaluate(["retry_existing_id=b; existing_id=a", "first_existing_id=a1; x", "none"], tx.blocking_id(V)) == ["b", "a1", None]
    assert evaluate(["existing_id=deadbeef; first_existing_id=00000001,x existing_id=zz"], tx.existing_ids(V)) == [["deadbeef", "00000001"]]
    assert evaluate([1.0, 0.85, 0.123456, 0.0], tx.format_confidence(V), "v DOUBLE") == ["1.0", "0.85", "0.1235", "0.0"]
    assert evaluate(["{a} {{b}} {c_1} {a}"], tx.template_vars(V)) == [["a", "c_1"]]
    problems = evaluate(["{a} {z}"], tx.template_problems(V, ["a", "b"]))[0]
    assert (problems.missing, problems.unknown) == (["b"], ["z"])
    assert [tuple(r) for r in evaluate(["papers/arxiv/2026/03", "articles/rss/2026/03"], tx.year_month_from_path(V))] == [
        (2026, 3), (None, None)]
    html = "<p>a</p><SCRIPT x>1<b></script><iframe src=q>z<object/><embed>"
    assert evaluate([html], tx.strip_tags(V)) == ["<p>a</p>z"]


def test_run_line(evaluate):
    cols = {n: F.lit(None).cast("string") for n in ("completed_at", "started_at", "profile", "kind", "status", "run_id",
                                                    "sources_checked", "ingested", "duration_seconds", "error")}
    cols |= {"completed_at": F.lit("t"), "profile": F.lit("p"), "kind": F.lit("manual"), "status": F.lit("completed"),
             "run_id": V, "degraded": F.lit(True), "degraded_reasons": F.array(F.lit("a"), F.lit("b")), "error": F.lit("bad"),
             "source_acquisition_errors": F.array(F.struct(F.lit("s").alias("source"), F.lit("k").alias("kind"), F.lit("d").alias("detail")))}
    assert evaluate(["r1"], tx.run_line(cols))[0].split("\n") == [
        "t p manual completed (degraded: a,b) run_id=r1 checked=None ingested=None duration=None", "    error=bad",
        "    source_error: source=s kind=k detail=d"]


def test_feed_dates(evaluate):
    values = ["Tue, 02 Jan 2024 03:04:05 +0000", "2 Jan 2024 05:04:05 +0200", "2024-01-02T03:04:05Z", "Tue, 02 Jan 2024 03:04:05 GMT", "junk"]
    now = F.lit(datetime(2020, 1, 1))
    got = evaluate(values, F.date_format(dates.feed_published(V, now=now), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2024-01-02 03:04:05"] * 4 + ["2020-01-01 00:00:00"]


def test_ranges(spark):
    today = date(2024, 3, 10)
    assert dates.resolve_range(today, days=2) == (date(2024, 3, 8), today)
    assert dates.resolve_range(today, date_from=date(2024, 1, 1), date_to=date(2024, 1, 3))[0] == date(2024, 1, 1)
    for bad in ({}, {"days": 1, "date_from": today}, {"date_from": today}):
        with pytest.raises(ValueError):
            dates.resolve_range(today, **bad)
    days = dates.backfill_days(spark, date(2024, 2, 28), date(2024, 3, 2)).collect()
    assert [r.day.day for r in days] == [28, 29, 1]
    assert dates.backfill_days(spark, today, today).count() == 0
    assert dates.since_hours("7d") == "168h" and dates.since_hours("60h") == "60h"
    assert dates.since_interval("2d") == timedelta(hours=48)


def test_query_stamps(evaluate):
    rows = [(date(2024, 1, 1), date(2024, 1, 3)), (date(2024, 1, 1), date(2024, 1, 1))]
    got = evaluate(rows, dates.query_stamps(F.col("a"), F.col("b")), "a DATE, b DATE")
    assert [tuple(r) for r in got] == [("202401010000", "202401022359"), ("202401010000", "202401010000")]


def test_tag_rules(evaluate):
    vocab = TagVocabulary("store")
    old = ["profile:a", "source:x", "store:repair-needed", "mine", "store:rejected:b", "feed-slug:f"]
    new = ["source:y", "profile:b", "profile:c", "full-text", "stray", "store:rejected:a"]
    schema = "o ARRAY<STRING>, n ARRAY<STRING>"
    assert evaluate([(old, new)], tg.merge_tags(F.col("o"), F.col("n"), vocab), schema) == [
        ["source:y", "full-text", "profile:c", "store:rejected:a", "store:rejected:b", "mine", "feed-slug:f"]]
    one = "v ARRAY<STRING>"
    assert evaluate([(["a", "source:x", "source:y"],), (["a"],)], tg.first_tag(V, "source:"), one) == ["x", None]
    family = tg.source_family(F.lit(None).cast("string"), V)
    assert evaluate([(["source:arxiv"],), (["source:blog"],), (["x"],)], family, one) == ["arxiv", "rss", "unknown"]
    problem = tg.archive_problem(F.lit("p"), V, vocab)
    rows = [(["ingested-by:store", "store:archive-missing"],), (["x"],), (["ingested-by:store"],)]
    assert evaluate(rows, problem, one) == ["path_and_archive_missing", "missing_ingested_by", None]


def test_tier_schemas(evaluate):
    good = '{"contributions":["a"],"method":"m","result":"r","relevance":"v"}'
    rows = [good, good.replace('["a"]', "[]"), good.replace('"m"', "null"), "no json", good.replace('["a"]', str(["x"] * 7).replace("'", '"'))]
    assert [r is not None for r in evaluate(rows, payloads.parse_tier1(V))] == [True, False, False, False, False]
    rows = ['{"claims":["  a  "]}', '{"claims":[]}', '{"claims":["a"],"datasets":["  "]}', '{"claims":["a", 3]}',
            '{"claims":["' + "z" * 600 + '"]}', "null", '{"claims":["a"],"builds_on":' + str(["b"] * 11).replace("'", '"') + "}"]
    got = evaluate(rows, payloads.parse_tier3(V))
    assert [r is not None for r in got] == [True, False, False, False, True, False, False]
    assert got[0].claims == ["a"] and got[0].datasets == [] and len(got[4].claims[0]) == 500


def test_write_outcome(evaluate):
    got = evaluate(['{"status":"weird"}', '{"status":"error","message":"m"}', '{"status":"invalid_input"}'], payloads.write_outcome(V))
    assert [tuple(r) for r in got] == [
        ("weird", "", "", '{"status":"weird"}'), ("error", "m", "", ""), ("invalid_input", "unknown", "", "")]


def test_payloads(spark):
    item = F.struct(F.lit("T").alias("title"), F.lit(9).alias("score"), F.lit("u").alias("url"), F.lit("").alias("reason"),
                    F.array(F.lit("t1"), F.lit("t2")).alias("tags"), F.array(F.lit("R"), F.lit("")).alias("related"))
    sink = F.struct(F.lit("S").alias("sender_name"), F.lit(True).alias("deliver"), F.lit("").alias("wake_mode"),
                    F.lit("c").alias("channel"), F.lit("ctx").alias("context"))
    message = payloads.item_message(F.lit("p"), F.lit("d"), item)
    kinds = spark.createDataFrame([("digest",), ("message",), ("toast",), ("agent",)], "k STRING")
    out = {r.k: r.x for r in kinds.select("k", payloads.payload_json(
        F.col("k"), digest=F.lit("{}"), message=message, item=item, profile=F.lit("p"), sink=sink).alias("x")).collect()}
    assert out["digest"] == "{}" and '"priority":"high"' in out["toast"] and '"context":"ctx"' in out["message"]
    assert '"channel":"c"' in out["agent"] and "wakeMode" not in out["agent"]
    assert "Tags: t1, t2\\nRelated: R" in out["message"] and "Reason" not in out["message"]


NOTE = (
    "---\r\nnote_type: summary\r\nsource_url: https://e.com/a\r\ntags:\r\n  - profile:x\r\n  - mine\r\nconfidence: 0.7\r\n---\r\n"
    "\r\n# A title  \r\n\r\n## Archive\r\npath: arxiv/2026/01/x.pdf\r\n\r\n## Summary\r\nplain\r\n\r\n## Profile Relevance\r\n"
    "### x\r\nScore: 8/10\r\nfits\r\nwell\r\n\r\n### y\r\nnothing\r\n\r\n## User Notes \r\nüñ\r\n## Archive\r\n### deep\r\n"
)


def test_parse_note_with_crlf(spark):
    from gleaner.sources.files import parse_notes

    rows = [("a", NOTE), ("b", "no fence"), ("c", "---\nx: 1\n---\nno title\n"), ("d", "---\n---\n# T\n## Archive\njunk\n"),
            ("e", "---\n---\n# Only title"), ("f", "---\nnever closed\n# T\n")]
    notes, errors = parse_notes(spark.createDataFrame(rows, "file STRING, text STRING"))
    got = {r.file: r for r in notes.collect()}
    a = got["a"]
    assert (a.title, a.source_url, a.tags, a.confidence) == ("A title", "https://e.com/a", ["profile:x", "mine"], 0.7)
    assert a.archive_path == "arxiv/2026/01/x.pdf" and a.summary == "plain"
    assert [(e.profile, e.score, e.reason) for e in a.relevance] == [("x", 8, "fits\nwell"), ("y", 0, "")]
    assert a.user_notes == "## User Notes \r\nüñ\r\n## Archive\r\n### deep\r\n"
    assert got["e"].title == "Only title" and got["e"].user_notes is None and got["e"].tags == []
    assert {r.file: r.error for r in errors.collect()} == {
        "b": "no_front_matter", "c": "no_title", "d": "bad_archive_section", "f": "no_front_matter"}


def test_parse_note_survives_long_preambles(spark):
    from gleaner.sources.files import parse_notes

    text = "---\n" + "k: v\n" * 20_000 + "---\n" + "line\n" * 50_000 + "# Late\n" + "x\n" * 50_000
    notes, _ = parse_notes(spark.createDataFrame([("a", text)], "file STRING, text STRING"))
    assert notes.first().title == "Late"


def test_repair_section_round_trip(spark):
    from gleaner.schemas import REPAIR

    df = spark.createDataFrame([((2, "parse", "broken", 0, "", "", 1, "http", "x"),)], f"r {REPAIR}")
    body = df.select(markdown.repair_body(F.col("r")).alias("b"))
    back = body.select(markdown.parse_repair(F.col("b")).alias("r")).first().r
    assert (back.tier2_attempts, back.tier2_last_stage, back.tier2_last_error, back.archive_last_kind) == (2, "parse", "broken", "http")
    odd = spark.createDataFrame([("- tier2_attempts: many\n- strange: 1\n",)], "b STRING")
    assert odd.select(markdown.parse_repair(F.col("b")).alias("r")).first().r.tier2_attempts == 0


def test_notes_fall_into_pieces_and_back(evaluate):
    texts = ["", "\n", "## A", "## A\n\n## A\nx\r\n## B  \n", "---\nt\n---\n# T\n\n## Archive\n\n## User Notes\n## Repair\nmine\n",
             "\n## User Notes\r\nx\n## Profile Relevance\ny", "no sections at all\n\n", "##  Odd\n##Not one\n", "é\n## ü\n ## x\n", None]
    assert evaluate(texts, markdown.joined_pieces(markdown.pieces(V))) == texts
    headings = evaluate(texts[4:5], F.transform(markdown.pieces(V), lambda p: p["heading"]))
    assert headings == [[None, "Archive", "User Notes"]]


def test_sections_are_set_added_and_taken_out(evaluate):
    note = "# T\n\n## Archive\n\n## Profile Relevance\n### p\nScore: 3/10\nr\n\n## User Notes\n## Repair\nmine\n"
    bare, empty = "# T\n", ""
    put = evaluate([note, bare, empty, None], markdown.set_section(V, "Repair", F.lit("b\n")))
    assert put == [note.replace("\n## Profile", "\n## Repair\nb\n\n## Profile"), "# T\n\n## Repair\nb\n", "\n## Repair\nb\n", None]
    assert evaluate(put[:1], markdown.set_section(V, "Repair", F.lit("c\n"))) == [put[0].replace("\nb\n", "\nc\n")]
    assert evaluate(put[:1], markdown.set_section(V, "Repair", F.lit(None).cast("string"))) == [note]
    assert evaluate([note], markdown.set_section(V, "User Notes", F.lit(None).cast("string"))) == [note.split("\n## User")[0]]
    repaired = F.from_json(F.lit('{"tier2_attempts":2,"tier2_last_error":"a\\nb"}'), REPAIR)
    text = evaluate([note], markdown.with_repair(V, repaired))[0]
    back = evaluate([text], markdown.parse_repair(F.regexp_extract(
        V, r"(?s)## Repair\n(.*?)\n## Profile", 1)))[0]
    assert (back.tier2_attempts, back.tier2_last_error, back.archive_attempts) == (2, "a b", 0)


def test_ids_of_holders(evaluate):
    lines = ["first_existing_id=n-1; first_slug='a=b'; retry_existing_id=<missing>; x", "Slug 'q' already in use", None,
             "refused existing_id=not hex", "xexisting_id=no; my_existing_id=no"]
    assert evaluate(lines, tx.existing_ids(V)) == [["n-1"], [], None, ["not"], []]
    assert evaluate(lines, tx.blocking_id(V)) == ["n-1", None, None, "not", None]
