"""The pipeline's near-duplicate stage against all pairs."""

from __future__ import annotations

import random
import time
from pathlib import Path

from pyspark.sql import functions as F

from gleaner.llm import simhash_dedup
from gleaner.llm.shared import settled

SCHEMA = "doc_id long, text string"


def plain_shingles(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))}


def plain_kept(rows):
    """The smallest id of each component of pairs that are alike or within three bits."""
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = {i: plain_shingles(t) for i, t in rows}
    prints = {i: simhash_dedup.fingerprint(t) for i, t in rows}
    for i in sets:
        for j in sets:
            if i < j and (5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
                          or (prints[i] ^ prints[j]).bit_count() <= 3):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return sorted(i for i in root if find(i) == i)


def edited(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(words)


def test_near_copies_of_five_words(spark):
    rng = random.Random(5)
    rows, far = [], 0
    for g in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(80, 450))]
        rows.append((10 * g, " ".join(base)))
        # from slight edits to some that are just beyond the limit
        for k in range(1, 6):
            rows.append((10 * g + k, edited(rng, base, max(1, len(base) * k // 120))))
            far += (simhash_dedup.fingerprint(rows[-1][1]) ^ simhash_dedup.fingerprint(rows[-k - 1][1])).bit_count() > 3
    rows += [(900, "one two three"), (901, "One  two THREE"), (902, "one two four")]
    assert far > 20
    got = simhash_dedup.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.doc_id for r in got) == plain_kept(rows)
    assert len(got) < len(rows) - far // 2


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    rows = [(i, edited(rng, base, 2)) for i in range(400)]
    got = simhash_dedup.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.doc_id for r in got] == plain_kept(rows) == [0]


def counted(monkeypatch):
    met, plain = [], simhash_dedup.alike_links
    monkeypatch.setattr(simhash_dedup, "alike_links", lambda pairs, sets: met.append(pairs.count()) or plain(pairs, sets))
    return met


def test_a_group_just_below_the_limit_meets_leaders_only(spark, monkeypatch):
    """2,000 texts share 170 of 192 words (Jaccard 0.76) and all keys of minima; none is alike, and pairs do not meet."""
    met, rng = counted(monkeypatch), random.Random(7)
    base = [f"w{rng.randrange(3000)}" for _ in range(170)]
    rows = [(i, " ".join(base[:80] + [f"own{i}x{k}" for k in range(22)] + base[80:])) for i in range(2000)]
    assert 0.7 < len(plain_shingles(rows[0][1]) & plain_shingles(rows[1][1])) / len(
        plain_shingles(rows[0][1]) | plain_shingles(rows[1][1])) < 0.8
    got = simhash_dedup.one_of_each(spark.createDataFrame(rows, SCHEMA)).count()
    prints = {simhash_dedup.fingerprint(t) for _, t in rows}
    assert got <= len(prints) and sum(met) < 100 * len(rows)


def test_mixed_group_equals_all_pairs(spark):
    """Copies of one text edited a little or a lot: all leaders leave some open, and rare shingles find the rest."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(3000)}" for _ in range(160)]
    rows = [(i, edited(rng, base, rng.choice([1, 2, 3, 4, 6, 9, 14]))) for i in range(220)]
    rows += [(1000 + i, " ".join(t.split()[rng.randint(0, 20):])) for i, t in rows[:60]] + [(2000, ""), (2001, None)]
    got = simhash_dedup.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.doc_id for r in got) == plain_kept([(i, t or "") for i, t in rows])


def test_settled_frames_leave_no_shuffle_files(spark):
    """What a stage settles holds no disk in shuffle files until the driver collects its garbage."""
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()

    def files():
        return {f.name for folder in folders for f in Path(folder.getPath()).glob("*/shuffle_*")}

    before = files()
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    kept = settled(sums.join(spark.range(7).withColumnRenamed("id", "k").hint("merge"), "k"))
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    # frames that were not settled keep theirs, so they can be read twice
    assert sorted(kept.collect()) == sorted(sums.collect()) == sorted(sums.collect())
    assert files() - before
