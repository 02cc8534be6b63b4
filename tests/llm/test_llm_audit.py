"""Operator 11 against a plain count, and the walk over subsets against direct sums."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import numpy as np

from gleaner.llm import filter_audit

DOCS = "doc_id long, text string, source string, mask int, good string"


def plain(docs, labels):
    """{(part, order, step): counts} by walking all documents through every order."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    smallest = {}
    for i, text, *_ in docs:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))

    def failed(i, text):
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        return {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
                "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                "E": i is not None and smallest[text] < i}

    out, removed_in_all = {}, Counter()
    parts = {d[2] or "" for d in docs}
    rows = [(d[2] or "", d[0], failed(d[0], d[1])) for d in docs]
    for part in parts:
        own = [(i, f) for p, i, f in rows if p == part]
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                lost = [i for i, f in left if f[letter]]
                left = [(i, f) for i, f in left if not f[letter]]
                removed_in_all[part, letter] += len(lost)
                out[part, "".join(order), step] = [
                    len(left), len(lost), sum(f[letter] for _, f in own) - len(lost),
                    sum(f[letter] and sum(f.values()) == 1 for _, f in own), sum(i in good for i in lost),
                    sum(i in toxic for i in lost)]
    return {k: (*v, removed_in_all[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, docs, labels):
    frame = spark.createDataFrame([(*d, 7, "clash") for d in docs], DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = filter_audit.interactions(filter_audit.cells(frame, marks)).collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost,
                                              r.shapley) for r in rows}
    assert len(got) == len(rows)
    return got


def test_all_orders_of_awkward_documents(spark):
    rng = random.Random(3)
    docs = [(None, "a b", "x"), (None, "a b", "x"), (1, None, None), (2, "", ""), (3, "a b", "x"), (3, "a b", "x"),
            (4, "lonG\x85word here " * 30_000, "y"), (5, "É$" * 40, "y")]
    for i in range(10, 90):
        words = [rng.choice(["ab", "CD", "x$", "é", *map(str, range(60))]) for _ in range(rng.choice([3, 49, 50, 80]))]
        docs.append((i, rng.choice([" ", "\t\n"]).join(words), rng.choice("xyz")))
    docs += [(i + 100, text, "y") for i, text, _ in docs[8:30]]
    labels = [(i, i % 2, i % 3 == 0 and 1 or 0) for i in range(0, 190, 2)] + [(3, None, 1), (3, 1, None), (None, 1, 1)]
    assert audited(spark, docs, labels) == plain(docs, labels)


def test_empty_tables(spark):
    assert audited(spark, [], [(1, 1, 1)]) == {}
    assert audited(spark, [(1, "a", "s")], []) == plain([(1, "a", "s")], [])


def test_a_text_that_a_third_of_all_rows_hold(spark):
    docs = [(i, "same $ text" if i % 3 == 0 else f"text {i}", "s") for i in range(600)]
    assert audited(spark, docs, []) == plain(docs, [])


def test_survivors_are_direct_sums():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 9, (3, 32, 2))
    for subset, alive in enumerate(filter_audit.survivors(counts).swapaxes(0, 1)):
        assert (alive == counts[:, np.arange(32) & subset == 0].sum(1)).all()
