"""Token counts of documents in flat token files, found by their separators (operator 8).

A flat file is a run of fixed-width token ids in which every document ends with a separator; nothing says where
documents begin.  Files are cut into blocks without regard to documents.  Each block is searched for the separator by
one vectorised comparison; a prefix scan over the blocks of a file then carries the number of separators so far and the
place of the last one into each block, which stitches documents that cross blocks.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gleaner.llm.shared import bounded_batches, stored

#: Tokens per block, and blocks that the first level of the scan takes together.
BLOCK, TOGETHER = 1 << 18, 1024

_ENCODINGS: dict[tuple[str, str], tiktoken.Encoding] = {}


def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The worker's encoding of a file of ranks; it has no special tokens."""
    if (ranks, pattern) not in _ENCODINGS:
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _ENCODINGS[ranks, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return _ENCODINGS[ranks, pattern]


def write_flat(docs: DataFrame, ranks: str, pattern: str, separator: int, id_col: str = "doc_id", text: str = "text",
               kind: str = "<u2", block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Encode whole texts and store them as flat files, one per task: (file, block, payload), and a manifest
    (file, ordinal, id) of the documents' order.  A null text has no token but its separator.  Both are read back from
    the shared checkpoint folder."""
    bounded_batches(docs.sparkSession)
    width = np.dtype(kind).itemsize
    schema = pa.schema([("file", pa.string()), ("block", pa.int32()), ("payload", pa.binary()),
                        ("first", pa.int64()), ("ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own, file = encoding(ranks, pattern), str(TaskContext.get().partitionId())
        end, held, count, number = np.array([separator], kind).tobytes(), bytearray(), 0, 0

        def row(payload: bytes | None, first: int | None, ids: list | None) -> pa.RecordBatch:
            at = number if payload is not None else None
            return pa.RecordBatch.from_pylist(
                [{"file": file, "block": at, "payload": payload, "first": first, "ids": ids}], schema=schema)

        for batch in batches:
            yield row(None, count, batch.column(0).to_pylist())
            count += batch.num_rows
            for value in batch.column(1).to_pylist():
                if value:
                    held += own.encode_to_numpy(value, disallowed_special=()).astype(kind).tobytes()
                held += end
                while len(held) >= block * width:
                    yield row(bytes(held[:block * width]), None, None)
                    del held[:block * width]
                    number += 1
        if held:
            yield row(bytes(held), None, None)

    both = stored(docs.select(F.col(id_col).cast("long"), text).mapInArrow(
        run, "file string, block int, payload binary, first long, ids array<long>"))
    manifest = both.where("payload is null").select("file", "first", F.posexplode("ids").alias("i", "id")).select(
        "file", (F.col("first") + F.col("i")).alias("ordinal"), "id")
    return both.where("payload is not null").select("file", "block", "payload"), manifest


def read_flat(spark: SparkSession, path: str, kind: str = "<u2", block: int = BLOCK) -> DataFrame:
    """Flat token files of a folder as blocks (file, block, payload)."""
    size = np.dtype(kind).itemsize * block
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                whole = content.as_buffer()
                for i, at in enumerate(range(0, len(whole), size)):
                    part = whole[at:min(at + size, len(whole))].to_pybytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path]), pa.array([i], pa.int32()), pa.array([part])], ["file", "block", "payload"])

    return files.mapInArrow(run, "file string, block int, payload binary")


def documents_of(blocks: DataFrame, separator: int, kind: str = "<u2", block: int = BLOCK) -> DataFrame:
    """The documents of flat files given as blocks: file, ordinal (from 0), start (in tokens), n_tokens (without the
    separator) and closed.  What follows a file's last separator is one more document that is not closed; a file that
    ends with a separator has none.  Two separators side by side hold an empty document.  An empty table gives an empty
    result; blocks must be of `block` tokens but for a file's last."""
    width = np.dtype(kind).itemsize

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [np.flatnonzero(np.frombuffer(p.as_buffer(), kind) == separator).astype(np.int32)
                  for p in batch.column(2)]
            size = [len(p.as_buffer()) // width for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size, pa.int32()), pa.array(at, pa.list_(pa.int32()))],
                ["file", "block", "size", "at"])

    found = stored(blocks.select("file", "block", "payload").mapInArrow(
        find, "file string, block int, size int, at array<int>"))
    rows = found.withColumn("start", F.col("block").cast("long") * block) \
        .withColumn("group", F.expr(f"block div {TOGETHER}")) \
        .withColumn("n", F.size("at").cast("long")) \
        .withColumn("last", F.when(F.size("at") > 0, F.col("start") + F.element_at("at", -1)))
    before = (W.unboundedPreceding, -1)
    inner = W.partitionBy("file", "group").orderBy("block").rowsBetween(*before)
    outer = W.partitionBy("file").orderBy("group").rowsBetween(*before)
    groups = rows.groupBy("file", "group").agg(F.sum("n").alias("n"), F.max("last").alias("last")).select(
        "file", "group", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("seps_before"),
        F.max("last").over(outer).alias("last_before"))
    stitched = rows.withColumn("seps_in", F.coalesce(F.sum("n").over(inner), F.lit(0))) \
        .withColumn("last_in", F.max("last").over(inner)).join(groups, ["file", "group"]) \
        .withColumn("ordinal", F.col("seps_before") + F.col("seps_in")) \
        .withColumn("carried", F.coalesce("last_in", "last_before", F.lit(-1).cast("long")))
    closed = stitched.select("file", "ordinal", "carried", "start", "at", F.posexplode("at").alias("i", "p")).select(
        "file", (F.col("ordinal") + F.col("i")).alias("ordinal"),
        (F.when(F.col("i") > 0, F.col("start") + F.get("at", F.col("i") - 1)).otherwise(F.col("carried")) + 1)
        .alias("start"), (F.col("start") + F.col("p")).alias("stop"), F.lit(True).alias("closed"))
    tail = rows.groupBy("file").agg(
        F.sum("n").alias("ordinal"), (F.coalesce(F.max("last"), F.lit(-1).cast("long")) + 1).alias("start"),
        F.max(F.col("start") + F.col("size")).alias("stop")).where("stop > start").withColumn("closed", F.lit(False))
    return closed.unionByName(tail).select("file", "ordinal", "start", (F.col("stop") - F.col("start")).alias("n_tokens"),
                                           "closed")
