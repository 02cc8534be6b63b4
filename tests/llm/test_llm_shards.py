"""Operator 12 against a plain layout of all documents along the same order."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

from gleaner.llm import byte_shards

DOCS = "doc_id long, text string, _key int, size string, shard string, piece long"


def md5(value):
    return hashlib.md5(("" if value is None else str(value)).encode()).hexdigest()


def plain(docs, shards=8, tolerance=100):
    """{shard: (id, text) in order}: each cut at the nearer end of its group if near, else of its document."""
    rows = sorted(docs, key=lambda d: (md5(d[1]), md5(d[0])[:16]))
    sizes = [len((t or "").encode()) + 1 for _, t in rows]
    upto = [0]
    for s in sizes:
        upto.append(upto[-1] + s)
    total, cuts = upto[-1], []
    for s in range(1, shards if rows else 1):
        place = s * total
        at = next(i for i in range(len(rows)) if shards * upto[i] <= place < shards * upto[i + 1])
        lo = hi = at
        while lo and md5(rows[lo - 1][1]) == md5(rows[at][1]):
            lo -= 1
        while hi < len(rows) and md5(rows[hi][1]) == md5(rows[at][1]):
            hi += 1
        if tolerance * min(place - shards * upto[lo], shards * upto[hi] - place) > total:
            lo, hi = at, at + 1
        cuts.append(lo if place - shards * upto[lo] <= shards * upto[hi] - place else hi)
    return {s: rows[a:b] for s, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(rows)]))}


def checked(spark, docs, shards=8):
    frame = spark.createDataFrame([(i, t, 1, "s", "x", 2) for i, t in docs], DOCS)
    want = plain(docs, shards)
    listed = byte_shards.shard_list(frame, shards=shards).collect()
    whole = byte_shards.sharded(frame, shards=shards)
    assert whole.columns[:6] == frame.columns and len(whole.columns) == 10
    for rows, text in ((listed, None), (whole.collect(), "text")):
        shard, slot = rows[0].__fields__[-2:] if rows else ("", "")
        for s in range(shards):
            own = sorted((r for r in rows if r[shard] == s), key=lambda r: r[slot])
            assert [r[slot] for r in own] == list(range(len(want.get(s, []))))
            assert [r.doc_id for r in own] == [i for i, _ in want.get(s, [])]
            assert text is None or [r.text for r in own] == [t for _, t in want.get(s, [])]
    assert Counter((r.doc_id, r["size"], r.crc) for r in listed) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    return want


def test_many_texts_of_all_lengths(spark):
    rng = random.Random(1)
    docs = [(i, "é" * rng.randint(0, 400)) for i in range(500)]
    sizes = [sum(len((t or "").encode()) + 1 for _, t in rows) for rows in checked(spark, docs).values()]
    assert max(sizes) - min(sizes) <= 802 + sum(sizes) / 8 / 50


def test_a_group_of_a_third_of_all_rows_is_cut_inside(spark):
    docs = [(i, "same text" if i % 3 else f"text {i * 7919 % 1000}") for i in range(400)]
    want = checked(spark, docs)
    assert sum(any(t == "same text" for _, t in rows) for rows in want.values()) > 3


def test_repeated_rows_and_nulls(spark):
    checked(spark, [(7, "again")] * 90 + [(None, None)] * 5 + [(None, ""), (3, None), (3, "")])


def test_one_text_longer_than_all_others(spark):
    checked(spark, [(0, "x" * 300_000), *[(i, "y" * i) for i in range(1, 40)]])


def test_fewer_rows_than_shards_and_none(spark):
    checked(spark, [(1, "a"), (2, "b")])
    checked(spark, [(1, None)])
    checked(spark, [])
    checked(spark, [(i, str(i)) for i in range(20)], shards=1)


def test_counting_rounds_are_few(spark, monkeypatch):
    rounds = []
    plain_count = byte_shards.histogram
    monkeypatch.setattr(byte_shards, "histogram", lambda *a: rounds.append(1) or plain_count(*a))
    docs = spark.range(20_000).selectExpr("id as doc_id", "repeat('x', cast(id % 50 as int)) as text")
    byte_shards.shard_list(docs)
    assert len(rounds) <= 6
