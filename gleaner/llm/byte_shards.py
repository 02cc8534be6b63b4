"""Shards of near-equal bytes by histogram sort (operator 12).

Documents are ordered by a key: a digest of the text, one of the id, and a number that tells identical rows apart.
Candidate boundaries between keys (probes) are refined in rounds.  In each, every partition counts exact rows and bytes
between the probes, one small table of sums goes to the driver, and each wanted cut looks for its place in the interval
that holds it.  With the cuts known all rows are exchanged once.

Laid along that order, a shard ends where its share of the bytes does.  There a group of equal texts is cut at its nearer
end if that is within the tolerance, else between the two documents nearest to the place.  So shards differ by twice the
tolerance, or by one document if that is larger, and a group is torn only where keeping it whole would cost more.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gleaner.llm.shared import free_name, settled, stored

#: Bytes of a key: digest of the text, digest of the id, number of the row.
TEXT_BYTES, ID_BYTES, ROW_BYTES = 16, 8, 8
WIDTH = TEXT_BYTES + ID_BYTES + ROW_BYTES
INSIDE, HIGHEST = 8 * (ID_BYTES + ROW_BYTES), (1 << 8 * WIDTH) - 1
#: Shards, the share of a shard that a cut may be off so as to keep a group whole (one in so many), probes of a cut a round.
SHARDS, TOLERANCE, PROBES = 8, 100, 16


class Spot(NamedTuple):
    """A boundary, with the rows and bytes of the keys below it."""

    key: int
    rows: int
    size: int


@dataclass
class Cut:
    """A wanted cut after `part` of `parts` of all bytes, and the interval of keys that holds its place."""

    part: int
    parts: int
    lo: Spot
    hi: Spot
    least: int
    most: int
    shard: bool
    inside: bool = False
    at: Spot | None = None

    def off(self, spot: Spot, total: int) -> int:
        """Bytes between its place and a boundary, times `parts`."""
        return abs(self.parts * spot.size - self.part * total)

    def settle(self, total: int) -> None:
        """Take the nearer end of the interval if no better one is to be had or wanted."""
        best = min(self.lo, self.hi, key=lambda s: self.off(s, total))
        one_group, near = self.least >> INSIDE == self.most >> INSIDE, self.off(best, total)
        if not self.shard:
            done = 2 * near <= total
        elif not self.inside:
            done = one_group and TOLERANCE * near <= total
        else:
            done = False
        if done or self.least == self.most:
            self.at = best
        self.inside |= one_group

    def probes(self, n: int) -> set[int]:
        """The ends of the interval and n boundaries spread over it: between groups while it holds several."""
        shift = 0 if self.inside else INSIDE
        first, last = self.least >> shift, self.most >> shift
        spread = {first - (first - last) * (i + 1) // n for i in range(n)}
        return {min(p << shift, HIGHEST) for p in spread | {first, last + 1}}


def keyed(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with three more columns, under the first free names of _size (UTF-8 bytes plus one; null: one), _crc
    (CRC-32 of the text; null: of no bytes) and _key.  The number in the key holds only once the rows are written."""
    body = F.coalesce(F.col(text), F.lit(""))
    own = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    key = F.concat(F.md5(body.cast("binary")), F.substring(F.md5(own.cast("binary")), 1, 2 * ID_BYTES),
                   F.lpad(F.hex(F.monotonically_increasing_id()), 2 * ROW_BYTES, "0"))
    return docs.withColumns({
        free_name(docs, "_size"): F.octet_length(body).cast("long") + 1, free_name(docs, "_crc"): F.crc32(body.cast("binary")),
        free_name(docs, "_key"): F.unhex(key)})


def _to_bytes(keys: list[int]) -> np.ndarray:
    return np.array([k.to_bytes(WIDTH, "big") for k in keys], f"S{WIDTH}")


def histogram(rows: DataFrame, key: str, size: str, probes: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Per interval between ascending probes that has rows: its number, rows, bytes, least and greatest key.

    Each partition counts for itself, so what is moved is bounded by partitions times probes.
    """
    edges = _to_bytes(probes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(edges) + 1
        count, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
        least, most = np.full(n, b"\xff" * WIDTH, f"S{WIDTH}"), np.zeros(n, f"S{WIDTH}")
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.sort(raw := np.frombuffer(b"".join(batch.column(0).to_pylist()), f"S{WIDTH}"))
            at = np.searchsorted(edges, raw, "right")
            count += np.bincount(at, minlength=n)
            total += np.bincount(at, batch.column(1).to_numpy(), n).astype(np.int64)
            ends = np.searchsorted(keys, edges, "left")
            first, last = np.concatenate([[0], ends]), np.concatenate([ends, [len(keys)]])
            some = last > first
            low, high = keys[first[some]], keys[last[some] - 1]
            least[some] = np.where(low < least[some], low, least[some])
            most[some] = np.where(high > most[some], high, most[some])
        some = np.flatnonzero(count)
        wide = [[bytes(x).ljust(WIDTH, b"\0") for x in ends[some]] for ends in (least, most)]
        yield pa.RecordBatch.from_arrays([
            pa.array(some.astype(np.int32)), pa.array(count[some]), pa.array(total[some]),
            *[pa.array(x, pa.binary()) for x in wide]], ["i", "n", "b", "lo", "hi"])

    found = rows.select(key, size).mapInArrow(run, "i int, n long, b long, lo binary, hi binary") \
        .groupBy("i").agg(F.sum("n").alias("n"), F.sum("b").alias("b"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return sorted((r.i, r.n, r.b, int.from_bytes(r.lo, "big"), int.from_bytes(r.hi, "big")) for r in found.collect())


def spans(probes: list[int], counted: list[tuple], end: int, shift: int) -> list[tuple[Spot, Spot, int, int]]:
    """Intervals that have rows: the boundaries, the least and the greatest key.  Only probes that end in `shift` zero bits
    part them, so that with `INSIDE` no group is cut."""
    out: list[tuple[Spot, Spot, int, int]] = []
    below, last = Spot(0, 0, 0), 0
    for i, n, size, low, high in counted:
        above = Spot(probes[i] if i < len(probes) else end, below.rows + n, below.size + size)
        if not out or any(not p % (1 << shift) for p in probes[last:i]):
            out.append((Spot(probes[i - 1] if i else 0, below.rows, below.size), above, low, high))
        else:
            out[-1] = (out[-1][0], above, out[-1][2], high)
        below, last = above, i
    return out


def cuts(rows: DataFrame, key: str, size: str, shards: int = SHARDS, pieces: int = 1) -> tuple[list[Spot], list[Spot]]:
    """The shards' cuts, and those of `pieces` pieces of each shard (the shards' own among them), ascending."""
    parts = shards * pieces
    found = histogram(rows, key, size, [])
    if not found:
        return [], []
    (_, n, total, least, most), = found
    ends = Spot(0, 0, 0), Spot(HIGHEST, n, total)
    wanted = [Cut(p, parts, *ends, least, most, False) for p in range(1, parts) if p % pieces]
    wanted += [Cut(s, shards, *ends, least, most, True) for s in range(1, shards)]
    while open_ := [c for c in wanted if c.at is None]:
        sharing = Counter((c.least, c.most, c.inside) for c in open_)
        probes = sorted(set().union(*[c.probes(PROBES * sharing[c.least, c.most, c.inside]) for c in open_]))
        counted = histogram(rows, key, size, probes)
        between_groups, between_rows = (spans(probes, counted, ends[1].key, shift) for shift in (INSIDE, 0))
        for cut in open_:
            cut.lo, cut.hi, cut.least, cut.most = next(
                s for s in (between_rows if cut.inside else between_groups) if cut.part * total < cut.parts * s[1].size)
            cut.settle(total)
    by_key = sorted(wanted, key=lambda c: c.at.key)
    return [c.at for c in by_key if c.shard], [c.at for c in by_key]


def _cuts_below(key: Column, edges: list[int]) -> Column:
    """How many edges lie at or below the key: the largest power of two that still does is added in turn."""
    if not edges:
        return F.lit(0)
    table = F.array(*[F.lit(e.to_bytes(WIDTH, "big")) for e in edges])
    powers = F.array(*[F.lit(1 << b) for b in reversed(range(len(edges).bit_length()))])
    return F.aggregate(powers, F.lit(0), lambda n, more: F.when(
        (n + more <= len(edges)) & (F.try_element_at(table, n + more) <= key), n + more).otherwise(n))


def placed(rows: DataFrame, key: str, size: str, shards: int = SHARDS) -> DataFrame:
    """Written rows with `shard` and `slot` (under free names) in place of the key, exchanged once by pieces of shards."""
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    between, pieces = cuts(rows, key, size, shards, -(-2 * partitions // shards))
    keys, starts = [s.key for s in between], [0, *[s.rows for s in between]]
    where = [(bisect_right(keys, p.key), p.rows) for p in (Spot(0, 0, 0), *pieces)]
    place = F.array(*[F.struct(F.lit(s).cast("int").alias("shard"), F.lit(at - starts[s]).cast("long").alias("before"))
                      for s, at in where])
    piece, shard, slot = (free_name(rows, n) for n in ("piece", "shard", "slot"))
    within = F.row_number().over(Window.partitionBy(piece).orderBy(key))
    return rows.withColumn(piece, _cuts_below(F.col(key), [p.key for p in pieces])) \
        .withColumns({shard: F.get(place, F.col(piece))["shard"],
                      slot: F.get(place, F.col(piece))["before"] + within - 1}).drop(piece, key)


def sharded(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """All rows and columns with _size, _crc, shard (from 0) and slot (place in the shard, gapless from 0), each under the
    first free of these names (underscores before it).

    Whole rows are stored once with their keys, counted in rounds, and exchanged once.  Pieces are twice as many as the
    session has shuffle partitions.  A null text has no bytes and equals an empty one; null ids equal empty ones.
    Identical rows are told apart by a number, so they can be cut anywhere.  Fewer rows than shards leave shards empty;
    an empty table gives an empty result.
    """
    rows = stored(keyed(docs, id_col, text))
    size, _, key = rows.columns[-3:]
    return placed(rows, key, size, shards)


def shard_list(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """doc_id, size, crc, shard and slot of every row as `sharded` places it, without moving texts."""
    rows = keyed(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")), "doc_id", "text")
    rows = settled(rows.select("doc_id", F.col("_size").alias("size"), F.col("_crc").alias("crc"), "_key"))
    return placed(rows, "_key", "size", shards)
