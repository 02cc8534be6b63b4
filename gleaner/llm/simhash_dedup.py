"""Near-duplicates by SimHash with a covering locality-sensitive hash (operator 3).

Every bit position gets a nonzero vector of four bits; a table is a nonzero vector of four bits as well, and its mask
keeps the positions whose vector has an odd product with the table's.  Three positions never span all four dimensions,
so for any three there is a table whose mask has none of them: a pair of fingerprints that differs in at most three
bits is equal under some of the fifteen masks.  No pair within the radius is missed.

A bucket of more than `BUCKET` different fingerprints is dealt again by a second set of masks over the bits the first
left open, which bounds what is compared at once by the number of bits then left.  A bucket yields a spanning forest of
its links, never all its pairs.

The pipeline's stage (`one_of_each`) links more: also texts whose sets of five-word shingles have a Jaccard similarity of
`ALIKE` or more.  Candidates share one of `BANDS` keys of `ROWS` minima each, which a pair at 0.8 misses with probability
5e-8; each is checked exactly.  A key's texts meet leaders first, and what is not connected then meets by its rarest
shingles, which spares pairs that cannot be alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gleaner.llm.components import components
from gleaner.llm.shared import bounded_batches, free_name, settled

RADIUS, WORDS, SEED = 3, 3, 42
#: Different fingerprints that a bucket may hold before it is dealt again.
BUCKET = 512
#: Near copies in the pipeline: words of a shingle, the least similarity in tenths, keys, minima of a key.
NEAR_WORDS, ALIKE, BANDS, ROWS = 5, 8, 32, 4
_RNG = np.random.default_rng(SEED)
FLIPS = _RNG.integers(0, 1 << 64, BANDS * ROWS, np.uint64)
FACTORS = _RNG.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def covering_masks(vector_of_bit: list[int]) -> list[int]:
    """The fifteen masks: bits whose vector has an odd product with 1, 2, ..., 15."""
    return [_signed(sum(1 << i for i, m in enumerate(vector_of_bit) if (m & table).bit_count() & 1))
            for table in range(1, 1 << (RADIUS + 1))]


#: Vectors of the bits: all fifteen in turn, and in runs of four or five for the second set.
FIRST = covering_masks([i % 15 + 1 for i in range(64)])
SECOND = covering_masks([i * 15 // 64 + 1 for i in range(64)])


def fingerprint(text: str | None) -> int:
    """SimHash of the three-word shingles of a text, A-Z lowered, as an unsigned 64-bit integer."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= WORDS:
        return digest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[:len(words) - WORDS + 1].tolist()
    ends = (ends[WORDS - 1:] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), 65536):
        part = zip(starts[at:at + 65536], ends[at:at + 65536])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in part], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def shingles(text: str | None, size: int = NEAR_WORDS) -> np.ndarray:
    """Hashes of the different shingles of `size` words of a text, A-Z lowered, in order; of all words if there are fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[:max(len(words) - size + 1, 1)].tolist()
    ends = (ends[min(size, len(words)) - 1:] - 1).tolist()
    return np.unique(np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(starts)))


def band_keys(hashes: np.ndarray) -> list[int]:
    """One key per band, as signed longs; none for a text without words."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1024):
        least = np.minimum(least, ((hashes[at:at + 1024, None] ^ FLIPS) * FACTORS).min(0))
    return [_signed(xxhash.xxh64_intdigest(row.tobytes(), band)) for band, row in enumerate(least.reshape(BANDS, ROWS))]


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two ordered sets of hashes have a Jaccard similarity of ALIKE tenths or more."""
    if 10 * min(len(a), len(b)) < ALIKE * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 10 * both >= ALIKE * (len(a) + len(b) - both)


def with_of_text(docs: DataFrame, text: str, fields: dict[str, tuple]) -> DataFrame:
    """The rows without their texts and with more columns: name to (Spark type, Arrow type, function of the text)."""
    bounded_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c != text]
    docs = docs.select(*kept, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(kept)).to_pylist()
            new = [pa.array([make(t) for t in texts], arrow) for _, arrow, make in fields.values()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], [*kept, *fields])

    return docs.mapInArrow(run, T.StructType([*[f for f in docs.schema.fields if f.name != text],
                                              *[T.StructField(n, spark) for n, (spark, *_) in fields.items()]]))


def with_fingerprints(docs: DataFrame, text: str, name: str) -> DataFrame:
    """The rows without their texts and with the fingerprint as a signed long."""
    return with_of_text(docs, text, {name: (T.LongType(), pa.int64(), lambda t: _signed(fingerprint(t)))})


def forest(prints: np.ndarray) -> np.ndarray:
    """Links of at most three bits, two columns, that connect what such links connect among the fingerprints."""
    left, found = prints.astype(np.int64).view(np.uint64), []
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            one = frontier.pop()
            near = np.bitwise_count(left ^ one) <= RADIUS
            if near.any():
                reached = left[near]
                found.append(np.stack([np.full(len(reached), one), reached], axis=1))
                frontier.extend(reached)
                left = left[~near]
    return np.concatenate(found).view(np.int64) if found else np.zeros((0, 2), np.int64)


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) among different fingerprints (column fp, each once) that connect all that radius 3 connects."""
    def tables(df: DataFrame, masks: list[int], mask: Column, table: str) -> DataFrame:
        """One row per table: its number, and the bits it keeps on top of those in `mask`."""
        each = F.array(*[F.struct(F.lit(i + 1).cast("short").alias(table),
                                  F.col("fp").bitwiseAND(F.lit(m).cast("long").bitwiseOR(mask)).alias("key"))
                         for i, m in enumerate(masks)])
        return df.withColumn("t", F.explode(each)).select(*df.columns, f"t.{table}", "t.key")

    keyed = tables(prints.select("fp"), FIRST, F.lit(0).cast("long"), "t1")
    shared = keyed.groupBy("t1", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = settled(keyed.join(shared, ["t1", "key"]))
    small = met.where(F.col("n") <= bucket).select("t1", F.lit(0).cast("short").alias("t2"), "key", "fp")
    first_mask = F.element_at(F.array(*[F.lit(m).cast("long") for m in FIRST]), F.col("t1").cast("int"))
    large = met.where(F.col("n") > bucket).select("fp", "t1", first_mask.alias("kept"))
    large = tables(large, SECOND, F.col("kept"), "t2")
    buckets = small.unionByName(large.select("t1", "t2", "key", "fp")).groupBy("t1", "t2", "key") \
        .agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1).select("fps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [forest(fps.values.to_numpy()) for fps in batch.column(0)]
            both = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["a", "b"])

    return buckets.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row.

    Fingerprints link at three or fewer differing bits; component_id is the smallest id reachable, the row's own
    included (null ids are left out of the minimum, and a group of null ids alone has a null component).  A null text
    and one without words have fingerprint zero and link like any other.  Repeated rows give repeated results; an empty
    table an empty one.
    """
    rows = settled(with_fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")),
                                     "text", "fp"))
    return with_components(rows).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                                        "component_id")


def placed(rows: DataFrame) -> DataFrame:
    """Different fingerprints (fp), the smallest doc_id of each (rep), and the root of the links of radius 3."""
    nodes = settled(rows.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    roots = components(links(nodes))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left") \
        .select("fp", "rep", F.coalesce("root", "fp").alias("root"))


def with_components(rows: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """Rows with doc_id and fp, and their component_id.  Equal fingerprints are one node, so copies cost one row each."""
    places = placed(rows) if places is None else places
    smallest = places.groupBy("root").agg(F.min("rep").alias("component_id"))
    return rows.join(places.join(smallest, "root").select("fp", "component_id"), "fp")


def alike_links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs of texts (x, y) with their roots (rx, ry) the links (a, b) between roots of texts that are alike."""
    both = pairs.join(sets.select(F.col("ka").alias("x"), F.col("hashes").alias("hx")), "x") \
        .join(sets.select(F.col("ka").alias("y"), F.col("hashes").alias("hy")), "y").select("rx", "ry", "hx", "hy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [alike(np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8"))
                    for x, y in zip(batch.column(2), batch.column(3))]
            found = batch.filter(pa.array(near, pa.bool_()))
            yield pa.RecordBatch.from_arrays(found.columns[:2], ["a", "b"])

    return both.mapInArrow(run, "a long, b long").distinct()


def prefixes(sets: DataFrame) -> DataFrame:
    """(key, ka, ahead, n): the rarest shingles of each set, with how many of its n shingles are not rarer.

    Shingles stand in one order for all sets, those of fewest sets first.  Two sets that are alike have
    `enough_ahead` of them from their first common one on, so it stands among the first fifth of each; a shingle of one
    set alone is nobody's first common one.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ka, hashes in zip(batch.column(0), batch.column(1)):
                keys = np.frombuffer(hashes.as_buffer(), "<i8")
                n = len(keys)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, ka.as_py())), pa.array(keys), pa.array(np.full(n, n, np.int32))], ["ka", "key", "n"])

    each = settled(sets.select("ka", "hashes").mapInArrow(run, "ka long, key long, n int"))
    held = each.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    order = Window.partitionBy("ka").orderBy(F.coalesce("c", F.lit(1)), "key")
    rows = each.join(held, "key", "left").withColumn("ahead", F.col("n") - F.row_number().over(order) + 1)
    return rows.where(F.col("c").isNotNull() & (10 * F.col("ahead") >= ALIKE * F.col("n"))).select("key", "ka", "ahead", "n")


def enough_ahead(ahead: Column, other_ahead: Column, n: Column, other_n: Column) -> Column:
    """Whether two sets may still have as many shingles in common as sets of their sizes need to be alike."""
    return (10 + ALIKE) * F.least(ahead, other_ahead) >= ALIKE * (n + other_n)


def joined_by_likeness(places: DataFrame, rows: DataFrame, texts: DataFrame) -> DataFrame:
    """`places` with the roots that texts alike connect: rows have ka, fp and bands; texts have ka and text.

    Texts that share a key of minima meet two of them, the key's leaders.  Texts of keys that this does not connect meet
    by rarest shingles: every pair that is not connected yet and could be alike by its places there.
    """
    places = settled(places)
    one = rows.groupBy("ka").agg(F.first("fp").alias("fp"), F.first("bands").alias("bands")) \
        .join(places.select("fp", "root"), "fp")
    keyed = one.select("ka", "root", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    met = settled(keyed.join(shared.select("key"), "key"))
    wanted = met.select(F.col("ka").alias("w")).distinct()
    # equal texts have equal sets, so any of them will do
    sets = settled(with_of_text(texts.join(wanted, F.col("ka") == F.col("w"), "left_semi").select("ka", "text"), "text", {
        "hashes": (T.BinaryType(), pa.binary(), lambda t: shingles(t).astype("<u8").tobytes())}).dropDuplicates(["ka"]))
    links_so_far: list[DataFrame] = []
    roots: DataFrame | None = None

    def still_open(met: DataFrame) -> DataFrame:
        """What meets in keys that are not connected yet, with today's roots and two leaders of the key."""
        now = met if roots is None else met.join(roots, met["root"] == roots["node"], "left").select(
            *[c for c in met.columns if c != "root"], F.coalesce(roots["root"], met["root"]).alias("root"))
        whole = F.struct(F.xxhash64("key", "ka").alias("by"), *[c for c in met.columns if c != "key"])
        open_ = now.groupBy("key").agg(
            F.min("root").alias("lo"), F.max("root").alias("hi"), F.array(F.min(whole), F.max(whole)).alias("leaders")) \
            .where("lo < hi").select("key", "leaders")
        return settled(now.join(open_, "key"))

    def connect(pairs: DataFrame) -> None:
        nonlocal roots
        links_so_far.append(settled(alike_links(pairs.distinct(), sets)))
        found = links_so_far[0]
        for more in links_so_far[1:]:
            found = found.unionByName(more)
        roots = settled(components(found))

    left = still_open(met)
    if not left.isEmpty():
        connect(left.select("ka", "root", F.explode("leaders").alias("leader")).where(F.col("root") != F.col("leader.root"))
                .select(F.col("ka").alias("x"), F.col("leader.ka").alias("y"), F.col("root").alias("rx"),
                        F.col("leader.root").alias("ry")))
        left = still_open(met)
    if not left.isEmpty():
        open_texts = left.groupBy("ka").agg(F.first("root").alias("root"))
        posted = settled(prefixes(sets.join(open_texts, "ka", "left_semi")).join(open_texts, "ka"))
        other = posted.select("key", *[F.col(c).alias(f"y_{c}") for c in posted.columns if c != "key"])
        both = posted.join(other, (posted["key"] == other["key"]) & (F.col("root") < F.col("y_root")) & enough_ahead(
            F.col("ahead"), F.col("y_ahead"), F.col("n"), F.col("y_n")))
        connect(both.select(F.col("ka").alias("x"), F.col("y_ka").alias("y"), F.col("root").alias("rx"),
                            F.col("y_root").alias("ry")))
    if roots is None:
        return places
    return places.withColumnRenamed("root", "r").join(roots, F.col("r") == F.col("node"), "left") \
        .select("fp", "rep", F.coalesce("root", "r").alias("root"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near-duplicates: of each component the row of the smallest id stays (nulls last, then by
    a hash of the text; of rows that agree in both, one).  All columns are kept.  Texts link within three bits, as in
    operator 3, and where their five-word shingles are alike."""
    key = [F.col(id_col).alias("doc_id"), F.xxhash64(F.lit(1), text).alias("ka"),
           F.xxhash64(F.lit(2), text, F.length(text)).alias("kb")]
    whole = docs.select(*key, F.col(text).alias("text"))
    rows = settled(with_of_text(whole, "text", {
        "fp": (T.LongType(), pa.int64(), lambda t: _signed(fingerprint(t))),
        "bands": (T.ArrayType(T.LongType()), pa.list_(pa.int64()), lambda t: band_keys(shingles(t)))}))
    different = rows.groupBy("doc_id", "ka", "kb").agg(F.count("*").alias("n"), F.first("fp").alias("fp"))
    nameless = F.when(F.col("component_id").isNull(), F.col("fp")).alias("g")
    w_id, w_a, w_b, w_n = (free_name(docs, n) for n in ("w_id", "w_a", "w_b", "w_n"))
    places = joined_by_likeness(placed(different), rows, whole.select("ka", "text"))
    best = with_components(different, places).groupBy("component_id", nameless) \
        .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "ka", "kb", "n")).alias("w")) \
        .select(F.col("w.doc_id").alias(w_id), F.col("w.ka").alias(w_a), F.col("w.kb").alias(w_b),
                F.col("w.n").alias(w_n))
    kept = docs.join(best, docs[id_col].eqNullSafe(F.col(w_id)) & (F.xxhash64(F.lit(1), docs[text]) == F.col(w_a))
                     & (F.xxhash64(F.lit(2), docs[text], F.length(docs[text])) == F.col(w_b)))
    # only rows that agree in id and text are left to be told apart, so whole texts are moved once
    single = kept.where(F.col(w_n) == 1).select(docs.columns)
    return single.unionAll(kept.where(F.col(w_n) > 1).dropDuplicates([w_id, w_a, w_b]).select(docs.columns))
