"""Score-gated enrichment: which tier runs for which row, text extraction, and the outcome."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.payloads import parse_tier1, parse_tier3
from gleaner.functions.text import clean_fragments, strip, strip_tags
from gleaner.operators.scoring import map_batches
from gleaner.vocabulary import (
    ATTEMPT_CAP, MIN_ARTICLE_CHARS, MIN_HTML_CHARS, TEXT_ABSTRACT, TEXT_HTML, TEXT_PDF, THRESHOLDS,
)


def threshold(name: str, column: Column | None = None) -> Column:
    """A profile's threshold, or the default where the profile has none."""
    default = F.lit(THRESHOLDS[name])
    return default if column is None else F.coalesce(column, default)


def cascade_gates(
    score: Column, has_text: Column, tier2_attempts: Column, tier3_attempts: Column, *,
    relevance: Column | None = None, full_text: Column | None = None, deep_extract: Column | None = None,
    extractor: bool = True, cap: int = ATTEMPT_CAP,
) -> dict[str, Column]:
    """Gate columns.

    `tier3_if_text` still needs full text in the same pass: combine it with the outcome of tier 2.  A terminal flag
    appears only where the tier would have run.
    """
    keep_text = score >= threshold("full_text", full_text)
    wants_t2 = keep_text & ~has_text & F.lit(extractor)
    deep = score >= threshold("deep_extract", deep_extract)
    t2_capped, t3_capped = tier2_attempts >= cap, tier3_attempts >= cap
    return {
        "keep_text": keep_text,
        "run_tier2": wants_t2 & ~t2_capped,
        "tier2_terminal": wants_t2 & t2_capped,
        "run_tier1": score >= threshold("relevance", relevance),
        "tier3_if_text": deep & ~t3_capped,
        "tier3_terminal_if_text": deep & t3_capped,
    }


def cascade_outcome(df: DataFrame) -> DataFrame:
    """Final flags from the gates and what each tier returned.

    Needs the gate columns plus `has_text`, `tier2_ok`, `tier1_ok`, `tier3_ok` (true where the tier gave a result).
    """
    text = (F.col("has_text") | (F.col("run_tier2") & F.col("tier2_ok"))) & F.col("keep_text")
    ran_t3 = F.col("tier3_if_text") & text
    return (
        df.withColumn("full_text_kept", text)
        .withColumn("run_tier3", ran_t3)
        .withColumn("tier3_terminal", F.col("tier3_terminal_if_text") & text)
        .withColumn("has_tier1", F.col("run_tier1") & F.col("tier1_ok"))
        .withColumn("has_tier3", ran_t3 & F.col("tier3_ok"))
        .withColumn(
            "repair_flag",
            (F.col("run_tier2") & ~F.col("tier2_ok")) | (F.col("run_tier1") & ~F.col("tier1_ok"))
            | (ran_t3 & ~F.col("tier3_ok")),
        )
    )


#: fixed values: parts of a page that are never its text, and tags that end a line
_FURNITURE = ("style", "nav", "header", "footer", "aside", "form", "noscript", "template", "svg")
_BLOCK_END = r"(?i)</(?:p|div|li|ul|ol|h[1-6]|tr|table|section|article|main|blockquote|pre|title)>|<br\s*/?>"
#: fixed values: the entities that survive in plain text most often; the ampersand comes last
_ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def main_text(html: Column) -> Column:
    """Readable text of a page: the article or main element where there is one, without page furniture.

    Runs over the whole page as column expressions; one text line per block element.
    """
    page = F.regexp_replace(html, r"(?s)<!--.*?-->", "")
    page = strip_tags(page)
    page = F.regexp_replace(page, rf"(?is)<({'|'.join(_FURNITURE)})\b[^>]*>.*?</\1>", "")
    body = F.coalesce(
        *[F.nullif(F.regexp_extract(page, rf"(?is)<{t}\b[^>]*>(.*)</{t}>", 1), F.lit("")) for t in
          ("article", "main", "body")],
        page,
    )
    text = clean_fragments(F.regexp_replace(body, _BLOCK_END, "\n"))
    for entity, char in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    text = F.regexp_replace(text, r"[ \t\r\f]+", " ")
    return strip(F.regexp_replace(text, r" ?\n[ \n]*", "\n"))


def extract_text(
    df: DataFrame, html: str = "html", pdf_text: str | None = None, minimum: int = MIN_HTML_CHARS
) -> DataFrame:
    """html, then pdf text, then the abstract alone: adds `extracted_text`, `text_tag`, `extract_problem`."""
    text = main_text(F.col(html))
    pdf = F.nullif(strip(F.col(pdf_text)), F.lit("")) if pdf_text else F.lit(None).cast("string")
    picked = (
        F.when(F.col("_ok"), F.struct(F.col("_text").alias("text"), F.lit(TEXT_HTML).alias("tag")))
        .when(pdf.isNotNull(), F.struct(pdf.alias("text"), F.lit(TEXT_PDF).alias("tag")))
        .otherwise(F.struct(F.lit(None).cast("string").alias("text"), F.lit(TEXT_ABSTRACT).alias("tag")))
    )
    return (
        df.withColumn("_text", text)
        .withColumn("_ok", F.coalesce(F.length("_text") >= minimum, F.lit(False)))
        .withColumn("_picked", picked)
        .withColumn("extracted_text", F.col("_picked.text"))
        .withColumn("text_tag", F.col("_picked.tag"))
        .withColumn(
            "extract_problem",
            F.when(F.col("extracted_text").isNotNull(), None)
            .when(F.col("_text").isNull(), "no_html").otherwise("too_short"),
        )
        .drop("_text", "_ok", "_picked")
    )


def article_text(df: DataFrame, html: str = "html") -> DataFrame:
    """`extract_text` for web articles, with their lower minimum."""
    return extract_text(df, html, minimum=MIN_ARTICLE_CHARS)


Model = Callable[[pd.DataFrame], pd.Series]


def enrich_tier(df: DataFrame, gate: str, model: Model, parse: Callable[[Column], Column], output: str) -> DataFrame:
    """Run a model on the rows that pass the gate only; an unusable answer is null, never an error.

    The gate stands before the Python step because the optimizer does not move filters below it.
    """
    todo = map_batches(df.where(F.col(gate)), model, "_answer").withColumn(output, parse(F.col("_answer")))
    rest = df.where(~F.coalesce(F.col(gate), F.lit(False)))
    return todo.drop("_answer").unionByName(rest, allowMissingColumns=True)


def tier2_extract(df: DataFrame, extractor: Model, gate: str = "run_tier2", tag: str = TEXT_PDF) -> DataFrame:
    """Full text through a plugged extractor of Arrow batches, for the gated rows; blank text counts as failed."""
    out = enrich_tier(df, gate, extractor, lambda text: F.nullif(strip(text), F.lit("")), "extracted_text")
    return out.withColumn("text_tag", F.when(F.col("extracted_text").isNotNull(), tag).otherwise(TEXT_ABSTRACT))


def tier1_enrich(df: DataFrame, model: Model, gate: str = "run_tier1") -> DataFrame:
    return enrich_tier(df, gate, model, parse_tier1, "tier1")


def tier3_extract(df: DataFrame, model: Model, gate: str = "run_tier3") -> DataFrame:
    return enrich_tier(df, gate, model, parse_tier3, "tier3")
