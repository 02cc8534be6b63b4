"""Toxicity by noisy-channel restoring and a classifier of the restored words (operator 6).

Look-alike characters, letters set apart and drawn-out letters are undone: the characters of a suspicious token span a
lattice of what they may stand for, and the path most likely under a trigram model of the corpus's characters is the
restored token.  The trigram counts come from all texts.  Words, word beginnings, and beginnings that several
different words share, as far as toxic labelled documents have them more often, then score the restored text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.shared import bounded_batches, settled

#: Labelled documents the classifier is fitted on at most (those of the smallest hashes of their ids), the evidence a
#: feature needs (likelihood-ratio statistic, toxic documents), and the score from which a document counts as toxic.
SAMPLE, EVIDENCE, SUPPORT, LIMIT = 20_000, 30.0, 5, 0.7
#: What look-alikes may stand for.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou", "#": "aeiou"}
#: Log-probabilities of the channel: a look-alike instead of its letter, and a character that stands for nothing.
ALIKE, EMPTY = math.log(0.5), math.log(0.3)
#: Letters of the beginnings that are features, and how many different words must share one for a feature of its own.
BEGINNINGS, SHARED = (4, 5, 6), (1, 2, 4)
#: Codes of characters: letters a to z, one for all other letters, and 0 for what is none.
CODES = 28
#: Tokens remembered per worker.
REMEMBERED = 500_000

_APART = re.compile(r"(?<![^\s])(?:[^\W_]|[@$!|+])(?:[ ._*-](?:[^\W_]|[@$!|+])){3,}(?![^\s.,;:?])")
_WORDS = re.compile(r"[^\W\d_]+")
_DRAWN = re.compile(r"(.)\1\1")
_BYTE_CODES = np.zeros(256, np.int64)
_BYTE_CODES[97:123] = np.arange(1, 27)
_BYTE_CODES[128:] = 27


def code(char: str) -> int:
    return ord(char) - 96 if "a" <= char <= "z" else 27 if char.isalpha() else 0


def trigram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(trigram, n) over all texts: each task counts its own, and the counts are added up."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CODES ** 3, np.int64)
        for batch in batches:
            joined = "  ".join(t for t in batch.column(0).to_pylist() if t)
            c = _BYTE_CODES[np.frombuffer(f"  {joined}  ".encode().lower(), np.uint8)]
            total += np.bincount((c[:-2] * CODES + c[1:-1]) * CODES + c[2:], minlength=CODES ** 3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["trigram", "n"])

    return docs.select(text).mapInArrow(run, "trigram int, n long").groupBy("trigram").agg(F.sum("n").alias("n"))


def character_model(counts: dict[int, int]) -> np.ndarray:
    """Log-probability of the third character after two, smoothed by the pair and single counts."""
    n = np.zeros(CODES ** 3)
    for key, value in counts.items():
        n[key] = value
    n = n.reshape(CODES, CODES, CODES)
    one = (n.sum((0, 1)) + 1) / (n.sum() + CODES)
    two = (n.sum(0) + 2 * one) / (n.sum((0, 2))[:, None] + 2)
    return np.log((n + 2 * two[None]) / (n.sum(2)[:, :, None] + 2))


@dataclass
class Model:
    """Character model, evidence of features by strength, weights of the strongest ones, and prior log-odds.

    `strength` orders the features; None stands for all features of a text, without weights.
    """

    characters: list
    strength: dict[str, float] | None
    weights: dict[str, float]
    prior: float
    remembered: dict[str, tuple[str, ...]] = field(default_factory=dict)
    beginnings: set[str] = field(default_factory=set)

    def __post_init__(self) -> None:
        self.beginnings = {f.partition("*")[0] for f in self.strength or () if "*" in f}

    def restore(self, token: str) -> str:
        """The most likely reading of a lowered token."""
        bare = token.rstrip("!?.,;:\"')]}$%&*#@+|_-") or token
        bare = bare.lstrip("\"'([{%&*#_.,;:-+|") or bare
        if not any(c.isalpha() for c in bare) or bare.isalpha() and not _DRAWN.search(bare):
            return bare
        paths: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        for i, char in enumerate(bare):
            drawn = i > 0 and bare[i - 1] == char and (bare[i - 2:i - 1] == char or bare[i + 1:i + 2] == char)
            reads = [(char, 0.0)] if char.isalpha() else [(x, ALIKE) for x in LOOKALIKES.get(char, "")] or [(char, 0.0)]
            if drawn or not char.isalnum():
                reads.append(("", EMPTY))
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (score, text) in paths.items():
                for read, cost in reads:
                    if read:
                        c = code(read)
                        key, value = (b, c), score + cost + self.characters[a][b][c]
                    else:
                        key, value = (a, b), score + cost
                    if key not in after or value > after[key][0]:
                        after[key] = value, text + read
            paths = after
        return max((score + self.characters[a][b][0], text) for (a, b), (score, text) in paths.items())[1]

    def _matters(self, word: str) -> bool:
        return self.strength is None or word in self.strength or any(word[:k] in self.beginnings for k in BEGINNINGS)

    def features(self, text: str | None) -> set[str]:
        """Features of the restored text: words; `stem*n` where at least n different words begin with the stem."""
        lowered = (text or "").lower()
        tokens = set(lowered.split())
        tokens.update(re.sub(r"[ ._*-]", "", m) for m in _APART.findall(lowered))
        known = self.remembered
        if len(known) > REMEMBERED:
            known.clear()
        words: set[str] = set()
        for token in tokens:
            got = known.get(token)
            if got is None:
                got = known[token] = tuple(w for w in _WORDS.findall(self.restore(token)) if self._matters(w))
            words.update(got)
        begun = Counter(w[:k] for w in words for k in BEGINNINGS if len(w) >= k)
        words.update(f"{stem}*{n}" for stem, count in begun.items() for n in SHARED if count >= n)
        return words if self.strength is None else {w for w in words if w in self.strength}

    def strongest(self, text: str | None) -> dict[str, str]:
        """By the first letters of the features, the strongest one of each."""
        best: dict[str, str] = {}
        for name in sorted(self.features(text), key=lambda f: (self.strength[f], f)):
            best[name[:BEGINNINGS[0]]] = name
        return best

    def score(self, text: str | None) -> float:
        """Probability of the label: the strongest features add their weights to the prior log-odds."""
        odds = self.prior + sum(self.weights[f] for f in self.strongest(text).values())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, modulo 3, is 1; null ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """A model from all texts (character counts) and at most `sample` labelled documents that are not held out.

    Repeated labels of a document count once, the larger wins; null ids and labels are left out.  Labelled texts that
    are near-copies of each other, by their smallest shingle hash, count once, so that what a group of copies has in
    common is not taken for what a label has in common.  Without labelled rows there are no features and even odds.
    """
    counts = {r.trigram: r.n for r in trigram_counts(docs, text).collect()}  # at most 28^3 rows
    characters = character_model(counts).tolist()
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # at most `sample` rows of two numbers, so it may be broadcast
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    words = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), " ")
    shingles = F.get(F.transform(F.array(words), lambda w: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))), F.lit(0))
    rows = docs.select(F.col(id_col).alias("own_id"), F.col(text).alias("text"))
    rows = rows.join(F.broadcast(chosen), F.col("own_id") == F.col("doc_id")) \
        .select("toxic", "text", F.array_min(shingles).alias("like"))
    rows = settled(rows.groupBy("toxic", "like").agg(F.max("text").alias("text")).select("toxic", "text"))
    size = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = size.get(0, 0), size.get(1, 0)
    if not clean or not toxic:
        return Model(characters, {}, {}, math.log((toxic + 0.5) / (clean + 0.5)))

    def weight(a: int, c: int) -> float:
        return math.log((a + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))

    def part(n: Column, all_n: Column, both: Column, every: int) -> Column:
        return F.when(n > 0, n * F.log(n * every / (all_n * both))).otherwise(0.0)

    a, c = F.col("toxic"), F.col("clean")
    both, every = a + c, clean + toxic
    statistic = 2 * (part(a, F.lit(toxic), both, every) + part(c, F.lit(clean), both, every)
                     + part(toxic - a, F.lit(toxic), every - both, every)
                     + part(clean - c, F.lit(clean), every - both, every))
    blank = Model(characters, None, {}, 0.0)
    kept = _by_label(rows, blank.features).where(
        (a >= SUPPORT) & (a * clean > c * toxic) & (statistic >= EVIDENCE)).collect()
    # of the features that a text has of one stem only the strongest counts, so weights are those of being the strongest
    first = Model(characters, {r.feature: weight(r.toxic, r.clean) for r in kept}, {}, 0.0)
    levels = _by_label(rows, lambda t: first.strongest(t).values()).collect()
    weights = {r.feature: weight(r.toxic, r.clean) for r in levels}
    return Model(characters, {f: first.strength[f] for f in weights}, weights,
                 math.log((toxic + 0.5) / (clean + 0.5)))


def _by_label(rows: DataFrame, features: Callable[[str | None], Iterable[str]]) -> DataFrame:
    """(feature, toxic, clean): documents of either label (toxic, text) that have a feature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for label, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[label].update(features(value))
        for label in (0, 1):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen[label]), pa.string()), pa.array([label] * len(seen[label]), pa.int32()),
                 pa.array(list(seen[label].values()), pa.int64())], ["feature", "label", "n"])

    return rows.mapInArrow(run, "feature string, label int, n long").groupBy("feature").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("clean"))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and score of every row; a null or empty text gets the prior's score.  Whole texts are read, repeated rows
    score alike, an empty table gives an empty result."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long"), text).mapInArrow(run, "doc_id long, score double")


def not_toxic(docs: DataFrame, model: Model, text: str = "text", limit: float = LIMIT) -> DataFrame:
    """The rows that score below the limit, with all their columns."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([model.score(t) < limit for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
