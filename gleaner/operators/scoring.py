"""Scoring of candidates: batches, a pluggable scorer, validation, and the relevance gate."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.functions.payloads import parse_scores
from gleaner.operators.ordered import numbered
from gleaner.schemas import SCORES
from gleaner.session import checkpoint_dir
from gleaner.vocabulary import SCORE_BATCH

Scorer = Callable[[pd.DataFrame], pd.DataFrame]

#: rows of whole batches that come to Python together
CALL_ROWS = 1024


def score_batches(
    candidates: DataFrame, keys: Sequence[str] = ("profile", "source"), order: str = "item_id",
    size: int = SCORE_BATCH, hot_rows: int | None = None,
) -> DataFrame:
    """Contiguous batches of `size` in the order of `order` within each (profile, source); `batch_id` from 0."""
    size = max(size, 1)
    ranked = numbered(candidates, keys, [F.col(order)], F.col(order), "_rn", hot_rows=hot_rows)
    return ranked.withColumn("batch_id", F.floor((F.col("_rn") - 1) / size).cast("bigint")).drop("_rn")


def poisoned(batches: DataFrame, failed: Column, keys: Sequence[str] = ("profile", "source")) -> DataFrame:
    """Flag every row of a (profile, source) of which any batch failed.

    One row per key is aggregated before the shuffle and looked up again, so no key's rows meet in one task.
    """
    bad = (
        batches.groupBy(*keys)
        .agg(F.bool_or(F.coalesce(failed, F.lit(False))).alias("poisoned"))
        .where(F.col("poisoned"))
    )
    return batches.join(bad, list(keys), "left").withColumn("poisoned", F.coalesce("poisoned", F.lit(False)))


def score_problem(item_id: Column, score: Column, reason: Column) -> Column:
    """What is wrong with one scored row; the tag list is cut, never judged."""
    return (
        F.when(F.coalesce(item_id, F.lit("")) == "", "no_id")
        .when(score.isNull() | (score != F.floor(score)) | ~score.between(1, 10), "bad_score")
        .when(reason.isNull(), "no_reason")
    )


def cut_tags(tags: Column, n: int = 5) -> Column:
    return F.slice(tags, 1, n)


def validate_scores(rows: DataFrame, batch: Sequence[str] = ("profile", "source", "batch_id")) -> DataFrame:
    """Add `problem`, `batch_ok` and cut `filter_tags`; one bad row fails its whole batch.

    A batch is bounded by the batch size, so its rows may meet in one window.
    """
    problem = score_problem(F.col("item_id"), F.col("score"), F.col("reason"))
    whole = Window.partitionBy(*batch)
    return (
        rows.withColumn("problem", problem)
        .withColumn("filter_tags", cut_tags(F.col("filter_tags")))
        .withColumn("batch_ok", F.every(F.col("problem").isNull()).over(whole))
    )


def last_wins(scores: DataFrame, keys: Sequence[str], position: str = "pos") -> DataFrame:
    """One row per key: the one at the highest position of the response."""
    others = [c for c in scores.columns if c not in keys]
    return (
        scores.groupBy(*keys)
        .agg(F.max_by(F.struct(*others), F.col(position)).alias("_row"))
        .select(*keys, "_row.*")
    )


def responses_to_scores(responses: DataFrame, content: str = "content") -> DataFrame:
    """Rows of (profile, source, batch_id, content) to scored rows with their position; bad JSON fails the batch."""
    parsed = responses.withColumn("_results", parse_scores(F.col(content)))
    keep = [c for c in responses.columns if c != content]
    return parsed.select(
        *keep, F.col("_results").isNotNull().alias("parsed"), F.posexplode_outer("_results").alias("pos", "_r")
    ).select(
        *keep, "parsed", "pos", F.col("_r.id").alias("item_id"), F.col("_r.score").alias("score"),
        F.col("_r.reason").alias("reason"), F.col("_r.tags").alias("filter_tags"),
    )


def attach_scores(candidates: DataFrame, scores: DataFrame, keys: Sequence[str] = ("profile", "item_id")) -> DataFrame:
    """Candidates with their scores; scores of unknown ids fall away."""
    return candidates.join(scores, list(keys), "left")


def relevance_gate(scored: DataFrame, threshold: int | str = 7) -> DataFrame:
    """Add `decision` (pass / drop) and `drop_reason`."""
    limit = F.col(threshold) if isinstance(threshold, str) else F.lit(threshold)
    return scored.withColumn(
        "drop_reason",
        F.when(F.col("score").isNull(), "not_returned_by_filter").when(F.col("score") < limit, "below_relevance"),
    ).withColumn("decision", F.when(F.col("drop_reason").isNull(), "pass").otherwise("drop"))


def score_candidates(
    candidates: DataFrame, scorer: Scorer | None, size: int = SCORE_BATCH, retries: int = 1,
    keys: Sequence[str] = ("profile", "source"), order: str = "item_id", prompts: DataFrame | None = None,
) -> DataFrame:
    """Score batches with a pluggable function of one batch (pandas in: candidates, pandas out: item_id, score, ...).

    With `prompts` (profile, prompt), each row of a batch carries its profile's prompt as column `prompt`.

    Rows are brought together by (keys, run of batches), about `CALL_ROWS` rows at a time, so a hot source spreads over many
    tasks and Spark's cost of a group is not paid per batch; the scorer still sees one batch a call.  A batch whose
    scorer keeps failing, or returns an invalid row, poisons its (profile, source).  Without a scorer nothing passes.
    What the scorer answers is checkpointed before anything branches on it, so each batch is scored once.
    """
    if scorer is None:
        return candidates.sparkSession.createDataFrame([], SCORES)
    batched = score_batches(candidates, keys, order, size)
    if prompts is not None:
        batched = batched.join(prompts.select("profile", "prompt"), "profile", "left")
    group = [*keys, "batch_id"]
    fields = "item_id STRING, score DOUBLE, confidence DOUBLE, reason STRING, filter_tags ARRAY<STRING>, pos INT"
    types = dict(batched.dtypes)
    schema = ", ".join(f"{k} {types[k]}" for k in group) + ", ok BOOLEAN, " + fields
    names = ["item_id", "score", "confidence", "reason", "filter_tags", "pos"]

    def score(rows: pd.DataFrame) -> tuple[pd.DataFrame, bool]:
        for _ in range(retries + 1):
            try:
                out = scorer(rows)
                return (none if out is None or out.empty else out), True
            except Exception:  # the scorer is foreign code: any failure fails the batch, not the job
                continue
        return none, False

    none = pd.DataFrame({n: [None] for n in names})

    def run_batches(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["batch_id", order], ignore_index=True)
        batch_ids, starts = np.unique(rows["batch_id"].to_numpy(), return_index=True)
        columns: dict[str, list] = {n: [] for n in ["batch_id", "ok", *names]}
        for batch_id, at, end in zip(batch_ids, starts, [*starts[1:], len(rows)], strict=True):
            out, ok = score(rows.iloc[at:end].drop(columns="_call").reset_index(drop=True))
            columns["batch_id"] += [batch_id] * len(out)
            columns["ok"] += [ok] * len(out)
            columns["pos"] += range(len(out))
            for name in names[:-1]:
                columns[name] += out[name].tolist() if name in out.columns else [None] * len(out)
        keyed = {k: pd.Series([v] * len(columns["ok"]), dtype=rows[k].dtype) for k, v in zip(keys, key[:-1], strict=True)}
        return pd.DataFrame({**keyed, **columns})[[*group, "ok", *names]]

    checkpoint_dir(candidates.sparkSession)
    calls = batched.withColumn("_call", F.floor(F.col("batch_id") / max(CALL_ROWS // max(size, 1), 1)))
    raw = calls.groupBy(*keys, "_call").applyInPandas(run_batches, schema).checkpoint()
    in_batch = raw.join(batched.select(*group, "item_id"), [*group, "item_id"], "left_semi")
    problem = score_problem(F.col("item_id"), F.col("score"), F.col("reason"))
    status = raw.groupBy(*group).agg(
        F.bool_or(~F.col("ok") | (F.col("item_id").isNotNull() & problem.isNotNull())).alias("_bad")
    )
    bad = status.groupBy(*keys).agg(F.bool_or("_bad").alias("_bad")).where(F.col("_bad")).select(*keys)
    return (
        last_wins(in_batch.drop("ok"), [*keys, "item_id"])
        .join(bad, list(keys), "left_anti")
        .select(
            "profile", "item_id", F.col("score").cast("int").alias("score"), "confidence", "reason",
            cut_tags(F.col("filter_tags")).alias("filter_tags"), "batch_id", F.lit(True).alias("batch_ok"),
        )
    )


def score_with_column(candidates: DataFrame, score: Column, confidence: Column | None = None) -> DataFrame:
    """Deterministic scoring by an expression: no Python, no batches."""
    return candidates.withColumn("score", score).withColumn(
        "confidence", score / F.lit(10.0) if confidence is None else confidence
    )


def map_batches(df: DataFrame, model: Callable[[pd.DataFrame], pd.Series], output: str) -> DataFrame:
    """Add a text column computed by a function of Arrow batches (the plug for model calls)."""
    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + f", `{output}` STRING"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            yield rows.assign(**{output: model(rows)})

    return df.mapInPandas(run, schema)
