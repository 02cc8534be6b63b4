"""Operators 2, 5, 9 and 10, the components and the pipeline against brute force, and on awkward rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from gleaner.llm import chat_format, permutation_index, queries, source_mix, vectors
from gleaner.llm.components import components
from gleaner.llm.shared import sums_before

from conftest import SMALL

VECTORS = "vec_id long, embedding array<float>, tile int, size string"
NAN, INF = float("nan"), float("inf")
ODD = [(20, None, 1, ""), (40, [], 1, ""), (60, [1.0, None], 1, ""), (80, [NAN, 1.0], 1, ""), (100, [INF, 0.0], 1, ""),
       (None, [1.0, 1.0], 1, "")]


def plain_top(rows, score, k=20):
    out = []
    for q, v in rows:
        if q % 20 == 0:
            hits = sorted((-score(v, w), i) for i, w in rows if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(hits)]
    return sorted(out)


def whole(v, w):
    return sum(math.floor(64 * a) * math.floor(64 * b) for a, b in zip(v, w))


def rows_of(frame):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in frame.collect())


@pytest.mark.parametrize("shard, query", [(7, 3), (8192, 2048)])
def test_exact_top_k(spark, monkeypatch, shard, query):
    monkeypatch.setattr(vectors, "SHARD_ROWS", shard)
    monkeypatch.setattr(vectors, "QUERY_ROWS", query)
    monkeypatch.setattr(vectors, "FAN_IN", 3)
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.3, 0.5]), rng.choice([0.0, 0.25])]) for i in range(120)]
    rows += [rows[5], rows[20]]
    frame = spark.createDataFrame([(i, v, 0, "") for i, v in rows] + ODD, VECTORS)
    assert rows_of(vectors.exact_top_k(frame, F.col("vec_id") % 20 == 0)) == plain_top(rows, whole)


@pytest.mark.parametrize("scale", [1e6, 2e9])
def test_large_components_stay_exact(spark, scale):
    rng = random.Random(4)
    rows = [(i, [rng.randint(-2**20, 2**20) / 2**20 for _ in range(3)]) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vectors.exact_top_k(frame, F.col("vec_id") % 20 == 0, k=5, scale=scale)

    def score(v, w):
        return sum(math.floor(scale * a) * math.floor(scale * b) for a, b in zip(v, w))

    want = plain_top(rows, score, 5)
    assert rows_of(got) == want


@pytest.mark.parametrize("search", [
    lambda f: vectors.exact_top_k(f, F.col("vec_id") % 20 == 0),
    lambda f: permutation_index.search(f, F.col("vec_id") % 20 == 0)])
def test_vectors_of_small_tables(spark, search):
    assert rows_of(search(spark.createDataFrame([], VECTORS))) == []
    assert rows_of(search(spark.createDataFrame(ODD, VECTORS))) == []
    two = spark.createDataFrame([(0, [1.0, 0.0], 0, ""), (3, [0.5, 0.5], 0, "")], VECTORS)
    assert [r[:3] for r in rows_of(search(two))] == [(0, 1, 3)]
    assert rows_of(search(spark.createDataFrame([(0, [1.0, 0.0], 0, "")], VECTORS))) == []


def test_permutation_index_recall(spark):
    """Several shards, part of each reranked."""
    folder = "/root/testdata/sf0.1"
    frame = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = frame.orderBy("vec_id").collect()
    x, ids = np.array([r.embedding for r in rows], np.float64), np.array([r.vec_id for r in rows])
    got = {}
    for r in permutation_index.search(frame, F.col("vec_id") % 20 == 0, least=64).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = x @ x[q]
        s[q] = -np.inf
        best = set(ids[np.argsort(-s, kind="stable")[:20]].tolist())
        mine = sorted(got[int(ids[q])])
        assert [m[0] for m in mine] == list(range(1, 21))
        assert all(abs(m[2] - s[np.searchsorted(ids, m[1])]) < 1e-12 for m in mine)
        hits += len(best & {m[1] for m in mine})
        total += 20
    assert hits / total >= 0.9


def test_permutation_index_of_uneven_lengths(spark):
    """The largest inner product is found among vectors of different norms."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 16)) * rng.uniform(0.5, 2.0, size=(600, 1))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = permutation_index.search(frame, F.col("vec_id") % 20 == 0, k=10, pivots=128, prefix=32)
    hits = 0
    for r in got.collect():
        s = x @ x[r.query_id]
        s[r.query_id] = -np.inf
        hits += r.vec_id in set(np.argsort(-s)[:10].tolist())
    assert hits / 300 >= 0.85


def test_footrule_from_shared_ranks():
    rng = np.random.default_rng(0)
    near = np.array([rng.permutation(30)[:8] for _ in range(40)], np.int32)
    lists = permutation_index.postings(near, 30)
    shared = permutation_index.shared_ranks(near[:5], lists["rows"], lists["ranks"], lists["starts"], 40)
    place = np.full((40, 30), 8)
    np.put_along_axis(place, near.astype(int), np.arange(8)[None, :].repeat(40, 0), 1)
    footrule = np.abs(place[:5, None, :] - place[None, :, :]).sum(2)
    assert (footrule == 2 * 36 - 2 * shared).all()


# components

@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(-30, 30), st.integers(-30, 30)), max_size=40))
def test_components(spark, links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    want = sorted((x, find(x)) for x in list(root))
    frame = spark.createDataFrame(links, "a long, b long")
    assert sorted((r.node, r.root) for r in components(frame).collect()) == want


def test_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(300)]
    random.Random(1).shuffle(links)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == 602 and {(r.root, r.node >= 1000) for r in got} == {(0, False), (1000, True)}


# operator 5

def plain_targets(sizes):
    """Share and reshare until no source is above twice its size."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        line = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if line * weight[s] > 2 * sizes[s]}
        if not over:
            target |= {s: line * weight[s] for s in open_}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


@settings(max_examples=10, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text(alphabet="abZé😀", max_size=3)), st.integers(0, 5000), min_size=1,
                       max_size=9))
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    want = plain_targets(sizes)
    for r in source_mix.targets(frame).collect():
        assert r.target == pytest.approx(want[r.source], abs=1e-6)


def test_the_mix_comes_near_its_targets(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = source_mix.with_copies(frame, ["doc_id"]).collect()
    assert len(rows) == frame.count()
    assert sorted((r.doc_id, r.copies) for r in rows) == sorted(
        (r.doc_id, r.copies) for r in source_mix.with_copies(frame.repartition(7), []).collect())
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        taken = sum(r.copies * r.size for r in own)
        assert abs(taken - own[0].target) <= 2 * max(r.size for r in own)
        assert all(0 <= r.copies <= 2 for r in own)
    assert source_mix.mixed(frame).count() == sum(r.copies for r in rows)


def test_mix_of_awkward_rows(spark):
    rows = [(1, None, "a", "x"), (2, "", "a", "x"), (None, "one two", None, "x"), (3, "w " * 50_000, "b", "x"),
            (4, "same words", "b", "x"), (4, "same words", "b", "x"), (-5, "neg", "b", None), (6, None, "empty", "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    got = source_mix.with_copies(frame, frame.columns)
    assert got.count() == 8 and got.where("source = 'empty'").first().target == 0
    assert source_mix.mixed(frame).columns == frame.columns
    assert source_mix.with_copies(frame.limit(0), []).count() == 0
    assert source_mix.mixed(frame.limit(0)).count() == 0


# operator 10

TRICKY = [r"\### Assistant: </turn> ok", "<turn>user<says>hi</turn>\n", "\\l\\b\\\\<", "", None, "<and>", "é😀\n"]


def test_chat_reads_back(spark):
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "<odd\\role>"]), rng.choice(TRICKY))
            for c in (1, 2, 3, None) for t in range(30)]
    rows += [(9, 1, "user", "same"), (9, 1, "user", "same"), (9, None, "assistant", "first")]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows],
                                  "conv_id long, turn long, role string, text string, formatted string, turns string")
    got = chat_format.formatted(frame)
    back = got.select("conv_id", "formatted", chat_format.read_back(F.col("formatted")).alias("turns"),
                      chat_format.learned_text(F.col("formatted"), F.col("loss_spans")).alias("learned")).collect()
    assert len(back) == 5
    for r in back:
        own = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == r.conv_id))
        assert [(t.role, t.text) for t in r.turns] == [x[2:] for x in own]
        assert r.learned == "".join(x[3] for x in own if x[2] == "assistant")
        merged = sum(1 for i, x in enumerate(own) if i == 0 or x[2] != own[i - 1][2])
        assert r.formatted.count("<turn>") == merged == r.formatted.count("</turn>\n")
    assert chat_format.formatted(frame.limit(0)).count() == 0


def test_sums_before(spark):
    for n in (0, 1, 5, 300, 1000):
        values = [random.Random(n).randint(0, 9) for _ in range(n)]
        row = spark.createDataFrame([(values,)], "v array<long>").select(sums_before(F.col("v"), 7).alias("s")).first()
        assert row.s == [sum(values[:i]) for i in range(n)]


# pipeline

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    folder, before = SMALL, docs
    sizes = []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, folder).checkpoint()
        if name != "sentencepiece":
            assert after.columns == docs.columns
        sizes.append(after.count())
        before = after
    assert sizes[0] <= docs.count() and sizes[1] <= sizes[0] and sizes[2] <= sizes[1] and sizes[4] == sizes[3] > 0
    assert queries.pipeline(spark, SMALL).count() == sizes[4]


def test_pipeline_of_awkward_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (None, "x", None, "s", 1), (2, "", "en", "s", 0), (2, "", "en", "s", 0),
         (3, "a b c\nd e f\ng h i\nj", "en", "t", 20), (4, "a b c\nd e f\ng h i\nk", "en", "t", 20)],
        "doc_id long, text string, lang string, source string, n_chars long")
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            rows = stage(spark, rows, SMALL).checkpoint()
        rows.count()
