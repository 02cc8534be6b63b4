"""A training corpus from raw documents: five stages, each over all its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again before the next one.
All but the last return the columns of the documents; the last returns the encoded documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm import line_dedup, piece_codec, simhash_dedup, source_mix, toxicity
from gleaner.session import apply_settings, checkpoint_dir

TOKENIZER = "piece_bpe_32k.model"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score as toxic.

    Null and empty texts score like texts without features; repeated rows stay or go together; an empty table stays
    empty.  Columns are those of `docs`.
    """
    labels = apply_settings(spark).read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.not_toxic(docs, toxicity.fit(docs, labels))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With repeated passages cut out; n_chars follows the text.  A document of which nothing is left goes.

    The first copy by id stays, of equal ids the first by the text's digest.  Null texts and texts of fewer than three
    lines stay as they are, and so does n_chars where nothing was cut; an empty table stays empty.
    """
    apply_settings(spark)
    rows = line_dedup.without_repeats(docs)
    rows = rows.where((F.col("lines_cut") == 0) | (F.trim("text") != ""))
    chars = F.when(F.col("lines_cut") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return rows.withColumn("n_chars", chars).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id (null last), of equal ids that of the smaller
    digest, of repeated rows one.  Null texts and texts without words are one group; an empty table stays empty.
    """
    apply_settings(spark)
    return simhash_dedup.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight has it: its copies are rows, and none if it is not taken.

    A null source is a source of its own; documents without words count with size zero; repeated rows count
    each; an empty table stays empty.
    """
    apply_settings(spark)
    return source_mix.mixed(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids and where each id's span of text bytes ends (packed little-endian 32-bit integers).

    The spans tile the text, so each starts where the one before ends.
    """
    apply_settings(spark)
    rows = piece_codec.encode(docs.select("doc_id", "source", "text"), public_tokenizers.path(TOKENIZER))
    return rows.select("doc_id", "source", F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"),
                       "ids", "ends")


STAGES = [("toxicity", drop_toxic), ("line_dedup", cut_repeated_lines), ("simhash", drop_near_copies),
          ("mix", mix_sources), ("sentencepiece", encode_pieces)]

#: Neither the scores nor the ids can be had in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, rows, sf_dir).write.parquet(f"{folder}/{name}")
        rows = spark.read.parquet(f"{folder}/{name}")
    return rows
