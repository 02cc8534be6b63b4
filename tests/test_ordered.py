"""Chunked ordered operators against plain Python, with one key holding most rows and many ties."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gleaner.operators import ordered


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    out = []
    for i in range(1500):
        key = "hot" if rng.random() < 0.7 else f"k{rng.randrange(12)}"
        out.append((key, i, start + timedelta(seconds=rng.randrange(400)), rng.randrange(-3, 4), rng.random() < 0.6))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "key STRING, id INT, ts TIMESTAMP, n INT, good BOOLEAN").repartition(5).persist()


def by_key(rows):
    groups = {}
    for r in sorted(rows, key=lambda r: (r[2], r[1])):
        groups.setdefault(r[0], []).append(r)
    return groups


ORDER = ["ts", "id"]


@pytest.mark.parametrize("chunks", [1, 3, 16, 150])
def test_running(frame, rows, chunks):
    order = [F.col(c) for c in ORDER]
    got = ordered.running(frame, ["key"], order, {
        "total": ("sum", F.col("n")), "top": ("max", F.col("n")), "low": ("min", F.col("n"))}, F.col("ts"), chunks=chunks, hot_rows=40)
    want = {}
    for group in by_key(rows).values():
        total, seen = 0, []
        for r in group:
            total += r[3]
            seen.append(r[3])
            want[r[1]] = (total, max(seen), min(seen))
    assert {r.id: (r.total, r.top, r.low) for r in got.collect()} == want


def test_strictly_before(frame, rows):
    got = ordered.running(frame, ["key"], [F.col(c) for c in ORDER], {"top": ("max", F.col("n"))}, F.col("ts"),
                          strictly_before=True, chunks=9, hot_rows=40)
    want = {}
    for group in by_key(rows).values():
        seen = []
        for r in group:
            want[r[1]] = max(seen) if seen else None
            seen.append(r[3])
    assert {r.id: r.top for r in got.collect()} == want


@pytest.mark.parametrize("chunks", [1, 7, 200])
def test_streaks(frame, rows, chunks):
    got = ordered.streaks(frame, ["key"], [F.col(c) for c in ORDER], F.col("good"), F.col("ts"), chunks=chunks, hot_rows=40)
    want = {}
    for group in by_key(rows).values():
        run = 0
        for r in group:
            run = run + 1 if r[4] else 0
            want[r[1]] = run
    assert {r.id: r.streak for r in got.collect()} == want


@pytest.mark.parametrize(("n", "chunks"), [(1, 5), (4, 60), (20, 300)])
def test_lookback_rows_are_exactly_the_previous_ones(frame, rows, n, chunks):
    from pyspark.sql.window import Window

    wide = ordered.with_lookback(frame, ["key"], ORDER, n, F.col("ts"), chunks, 40)
    before = Window.partitionBy("key", ordered.CHUNK).orderBy(*ORDER).rowsBetween(-n, -1)
    got = wide.withColumn("ids", F.collect_list("id").over(before)).where(~F.col(ordered.HALO))
    want = {}
    for group in by_key(rows).values():
        ids = [r[1] for r in group]
        for i, r in enumerate(group):
            want[r[1]] = ids[max(0, i - n):i]
    assert {r.id: r.ids for r in got.collect()} == want


def test_chunks_split_the_hot_key(frame, rows):
    sizes = [r["count"] for r in ordered.with_chunks(frame, ["key"], F.col("ts"), 16, 300)[0].groupBy("key", ordered.CHUNK).count().collect()]
    assert max(sizes) < len(rows) / 8


def test_string_order_with_shared_prefix(spark):
    ids = [f"https://example.com/item/{i:05d}" for i in range(900)]
    df = spark.createDataFrame([("hot", i) for i in ids], "key STRING, item STRING").repartition(4)
    chunked = ordered.with_chunks(df, ["key"], F.col("item"), 10, 1)[0]
    assert max(r["count"] for r in chunked.groupBy(ordered.CHUNK).count().collect()) < 200
    got = ordered.numbered(df, ["key"], [F.col("item")], F.col("item"), chunks=10, hot_rows=1)
    assert {r.item: r.rn for r in got.collect()} == {x: i + 1 for i, x in enumerate(ids)}


def test_several_hot_text_keys_and_stray_values_are_split(spark):
    """Two hot feeds of different prefixes and one odd id: no chunk holds more than three times its share."""
    rows = [("a", f"https://a.example.com/{i:06d}") for i in range(2000)] + [("b", f"urn:b:{i:06d}") for i in range(2000)]
    rows += [("a", "!odd"), ("b", "\u00fcber"), ("c", "x")]
    df = spark.createDataFrame(rows, "key STRING, item STRING").repartition(6)
    chunked = ordered.with_chunks(df, ["key"], F.col("item"), 16, 100)[0]
    sizes = [r["count"] for r in chunked.groupBy("key", ordered.CHUNK).count().collect()]
    assert max(sizes) <= 3 * len(rows) / 16
    got = ordered.numbered(df, ["key"], [F.col("item")], F.col("item"), chunks=16, hot_rows=100)
    for key in "abc":
        own = sorted((item for k, item in rows if k == key), key=str.encode)
        assert {r.item: r.rn for r in got.where(F.col("key") == key).collect()} == {x: i + 1 for i, x in enumerate(own)}


def test_paged_lists_are_whole(frame, rows):
    pages = ordered.paged(frame, ["key"], [F.col(c) for c in ORDER], F.col("ts"), 10, chunks=6, hot_rows=40)
    sizes = {(r.key, r.page): r["count"] for r in pages.groupBy("key", "page").count().collect()}
    assert max(sizes.values()) == 10 and sum(sizes.values()) == len(rows)


def test_mark_first(frame, rows):
    got = {r.id for r in ordered.mark_first(frame, ["key"], [F.col(c) for c in ORDER]).where("is_first").collect()}
    assert got == {g[0][1] for g in by_key(rows).values()}


def test_empty_input(frame):
    empty = frame.limit(0)
    assert ordered.numbered(empty, ["key"], [F.col("id")], F.col("id")).count() == 0
    assert ordered.streaks(empty, ["key"], [F.col("id")], F.col("good"), F.col("id")).count() == 0


@pytest.mark.parametrize("chunks", [12, 100])
def test_frequent_values_are_cut_along_the_second_column(spark, chunks):
    rng = random.Random(2)
    data = [("hot", 5 if rng.random() < 0.9 else rng.randrange(10), f"id-{i:04d}") for i in range(1000)]
    df = spark.createDataFrame(data, "key STRING, score INT, item STRING").repartition(3)
    split = [-F.col("score"), F.col("item")]
    chunked = ordered.with_chunks(df, ["key"], split, chunks, 1)[0]
    assert max(r["count"] for r in chunked.groupBy(ordered.CHUNK).count().collect()) < 1000 / chunks * 3
    got = ordered.numbered(df, ["key"], [F.col("score").desc(), F.col("item")], split, chunks=chunks, hot_rows=1)
    want = {item: i + 1 for i, (_, _, item) in enumerate(sorted(data, key=lambda r: (-r[1], r[2])))}
    assert {r.item: r.rn for r in got.collect()} == want


def test_only_hot_keys_are_cut(frame):
    cut, any_hot = ordered.with_chunks(frame, ["key"], F.col("ts"), 16, 300)
    assert any_hot and {r.key for r in cut.where(F.col(ordered.CHUNK) >= 0).select("key").distinct().collect()} == {"hot"}
    plain = ordered.numbered(frame, ["key"], [F.col("id")], F.col("id"))
    assert "Join" not in plain._jdf.queryExecution().executedPlan().toString()
