"""Repair of conversations that lost, doubled or mangled turns (operator 13).

A conversation is well formed if the initials of its roles read `(s?(ua)+)?`.  Every row is kept, given another role or
deleted, and empty rows may be inserted; a cost DP from the end gives the cheapest total from every node (rows done,
state of the pattern).  Among the cheapest edits those with the least audit (initials of the edits) are wanted.  Arcs on
cheapest paths are ranked by the first 1, 2, 4, ... letters of the audits that begin with them: the rank for the double
length is the rank of the pair of an arc's own rank and that of the best arc where its pointer ends, and the pointer
moves on through that arc.  The arcs of a node differ in their letter, as each state has one role that may come next, so
ranks never leave two best arcs.

A row is one letter to the DP: the class of its role and its fault.  Very long conversations are put together from
chunks and walked in blocks, so a task holds a letter per row of a conversation, as its audit does anyway; texts are
streamed past the audit in order and never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gleaner.llm.shared import BATCH_BYTES, BATCH_ROWS, bounded_batches, settled
from gleaner.operators import ordered

#: Costs of the edits, of leaving a truncated row in, and letters of the edits in the order of their codes.
RENAME, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
EDITS = "DIKR"
#: States: nothing yet, after the system's turn, after the user's, after the assistant's (the first and last may end).
NEXT = np.array([2, 2, 3, 2])
#: State after a kept row by class of role (system, user, assistant, other) and state; 4: not allowed.
KEPT = np.array([[1, 4, 4, 4], [2, 2, 4, 2], [4, 4, 3, 4], [4, 4, 4, 4]])
AT_END = np.array([0, 4, 2, 0])
ROLES = ("user", "user", "assistant", "user")
#: Faults of a row; a row's letter is the one numbered 4 * class + fault.
SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)
LETTERS = "ABCDEFGHIJKLMNOP"
#: Rows walked at once, nodes of paths laid out at once, and rows of a conversation beyond which it is cut into chunks.
BLOCK, LAID_OUT, HOT_ROWS = 4096, 1 << 20, 200_000
_FAR = 1 << 40


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with a twentieth each dropped, emptied, without `.!?`, repeated and said by the user,
    as the CRC-32 of `conv_id:turn` has it; null roles and texts, and nulls in that key, are one space."""
    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(filled("text"), "[.!?]", "")).otherwise(filled("text"))
    copies = F.array_repeat(F.lit(0), F.when(fate == 3, 2).otherwise(1))
    return turns.where(fate != 0).select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(filled("role")).alias("role"), text.alias("text"),
        F.explode(copies).alias("copy")).drop("copy")


def _keyed(turns: DataFrame) -> DataFrame:
    """Rows with `conv` (never null), turn, two digests of role and text that settle ties of a turn, role and text."""
    role, text = (F.coalesce(n, F.lit(" ")) for n in ("role", "text"))
    rows = turns.select(F.struct("conv_id").alias("conv"), "turn", role.alias("role"), text.alias("text"))
    return rows.select("conv", "turn", F.xxhash64(F.lit(1), "role", "text").alias("ha"),
                       F.xxhash64(F.lit(2), "text", "role").alias("hb"), "role", "text")


def _letters(turns: DataFrame) -> DataFrame:
    """(conv, turn, ha, hb, letters): one letter per row, equal rows of a turn together."""
    body = F.rtrim("text", F.lit(" \t\n\x0b\f\r"))
    fault = F.when(body == "", BLANK).when(F.substring(body, -1, 1).isin(".", "!", "?"), SOUND).otherwise(CUT_OFF)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    slim = _keyed(turns).select("conv", "turn", "ha", "hb", kind.alias("kind"), fault.alias("fault"))
    rows = slim.groupBy("conv", "turn", "ha", "hb", "kind", "fault").agg(F.count("*").cast("int").alias("n"))
    rows = ordered.mark_first(rows, ["conv", "ha", "hb"], [F.col("turn")])

    def letter(fault: Column) -> Column:
        return F.substr(F.lit(LETTERS), 4 * F.col("kind") + fault + 1, F.lit(1))

    again = letter(F.when(F.col("fault") == BLANK, BLANK).otherwise(DUPLICATE))
    first = F.when(F.col("is_first"), letter(F.col("fault"))).otherwise(again)
    return rows.select("conv", "turn", "ha", "hb", F.concat(first, F.repeat(again, F.col("n") - 1)).alias("letters"))


def _joined(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct(*order, "letters")))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p["letters"]), "").alias("letters"))


def _before(code: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Costs to the end before rows of these codes (rows, states), from those after them."""
    kind, fault = code >> 2, code & 3
    stays = np.where((fault == BLANK) | (fault == DUPLICATE), _FAR, np.where(fault == CUT_OFF, TRUNCATED, 0))[:, None]
    wide = np.concatenate([after, np.full((len(code), 1), _FAR)], axis=1)
    kept = np.take_along_axis(wide, KEPT[kind], axis=1) + stays
    best = np.minimum(np.minimum(kept, after[:, NEXT] + RENAME + stays), after + DELETE)
    return np.minimum(best, np.minimum(best[:, NEXT] + INSERT, best[:, NEXT[NEXT]] + 2 * INSERT))


def _walk(codes: list[np.ndarray], ends: np.ndarray, last: np.ndarray, states: np.ndarray
          ) -> list[tuple[str, int]]:
    """The least cheapest audit through each block of rows from a state, and the state it ends in.

    `ends` are costs after each block; only a `last` block may insert after its rows.
    """
    sizes = np.array([len(c) for c in codes])
    first = np.concatenate([[0], np.cumsum(sizes + 1)])
    cost = np.zeros((first[-1], 4), np.int64)
    cost[first[1:] - 1] = ends
    code = np.full(first[-1], -1)
    for c, at in zip(codes, first):
        code[at:at + len(c)] = c
    for back in range(1, sizes.max(initial=0) + 1):
        at = first[1:][sizes >= back] - 1 - back
        cost[at] = _before(code[at], cost[at + 1])
    layer, state = np.divmod(np.arange(4 * len(code)), 4)
    flat, inner = cost.reshape(-1), code[layer] >= 0
    kind, fault = code[layer] >> 2, code[layer] & 3
    may_stay = inner & (fault != BLANK) & (fault != DUPLICATE)
    left_in = np.where(fault == CUT_OFF, TRUNCATED, 0)
    kept = KEPT[np.where(inner, kind, 3), state]
    closing = np.zeros(len(code), bool)
    closing[first[1:] - 1] = last
    options = [(inner, 4 * layer + 4 + state, DELETE), (inner | closing[layer], 4 * layer + NEXT[state], INSERT),
               (may_stay & (kept < 4), 4 * layer + 4 + kept, left_in),
               (may_stay, 4 * layer + 4 + NEXT[state], RENAME + left_in)]
    end = np.stack([np.where(ok, to, 4 * layer + state) for ok, to, _ in options], axis=1)
    cheapest = np.stack([ok & (flat[end[:, i]] + price == flat) for i, (ok, _, price) in enumerate(options)], axis=1)
    stop = ~cheapest.any(axis=1)
    # an arc's letter from 1; 0 ends an audit, arcs that are not on a cheapest path come last
    rank = np.where(cheapest, np.arange(1, 5), 9)
    rank[stop, 0] = 0
    end[stop] = np.flatnonzero(stop)[:, None]
    pointers, nodes = [], np.arange(len(flat))
    best = rank.argmin(axis=1)
    letters = np.where(stop, 0, best + 1)
    while True:
        pointers.append(end[nodes, best])
        if (stop[pointers[-1]]).all():
            break
        after = best[end]
        paired = rank.astype(np.int64) * (rank.max() + 1) + rank[end, after]
        end = end[end, after]
        rank = np.unique(paired, return_inverse=True)[1].reshape(paired.shape)
        best = rank.argmin(axis=1)
    out: list[tuple[str, int]] = []
    starts = 4 * first[:-1] + states
    for at in range(0, len(starts), max(LAID_OUT >> len(pointers), 1)):
        path = starts[at:at + max(LAID_OUT >> len(pointers), 1), None]
        for pointer in reversed(pointers):
            path = np.stack([path, pointer[path]], axis=2).reshape(len(path), -1)
        marks = np.frombuffer(b"\0" + EDITS.encode(), np.uint8)[letters[path]]
        finish = pointers[-1][path[:, 0]] if len(pointers) else path[:, -1]
        out += [(m.tobytes().rstrip(b"\0").decode(), int(s) & 3) for m, s in zip(marks, finish)]
    return out


def cheapest_edits(rows: list[str]) -> list[tuple[int, str]]:
    """Cost and least audit of conversations given by the letters of their rows."""
    codes = [np.frombuffer(r.encode(), np.uint8).astype(np.int64) - ord(LETTERS[0]) for r in rows]
    found: dict[int, str] = {}
    group: list[int] = []
    for i in sorted((i for i, c in enumerate(codes) if len(c) <= BLOCK), key=lambda i: len(codes[i])) + [-1]:
        if group and (i < 0 or len(group) * len(codes[i]) > 4 * BLOCK):
            walked = _walk([codes[j] for j in group], np.tile(AT_END, (len(group), 1)), np.ones(len(group), bool),
                           np.zeros(len(group), int))
            found |= {j: audit for j, (audit, _) in zip(group, walked)}
            group = []
        group.append(i)
    for i, code in enumerate(codes):
        if i not in found:
            after, ends = AT_END[None], []
            for at in reversed(range(len(code))):
                if (at + 1) % BLOCK == 0 or at + 1 == len(code):
                    ends.append(after)
                after = _before(code[at:at + 1], after)
            state, audit = 0, []
            for at, end in zip(range(0, len(code), BLOCK), reversed(ends)):
                last = np.array([at + BLOCK >= len(code)])
                (part, state), = _walk([code[at:at + BLOCK]], end, last, np.array([state]))
                audit.append(part)
            found[i] = "".join(audit)
    return [(_price(codes[i], found[i]), found[i]) for i in range(len(rows))]


def _price(code: np.ndarray, audit: str) -> int:
    edits = np.frombuffer(audit.encode(), np.uint8)
    own = edits[edits != ord("I")]
    kept = (code & 3 == CUT_OFF) & (own != ord("D"))
    return int(INSERT * (len(edits) - len(own)) + DELETE * (own == ord("D")).sum() + RENAME * (own == ord("R")).sum()
               + TRUNCATED * kept.sum())


def audited(turns: DataFrame) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): gaps, blank, duplicate, truncated, illegal, cost, audit.

    Rows go by turn (nulls first), those of one turn by digests of role and text, so equal rows are neighbours.  Null
    roles and texts are one space; null ids make up one conversation.  A row is blank, else a duplicate if its role and
    text stood earlier, else truncated if it ends in none of `.!?`.  Gaps are turns missing between the first and the
    last, nulls ignored.  Illegal are neighbours, as given, other than system-user, user-assistant and assistant-user.
    Repeated rows are duplicates; an empty table gives an empty result.
    """
    bounded_batches(turns.sparkSession)
    rows = settled(_letters(turns))
    gaps = rows.groupBy("conv").agg(F.coalesce(
        F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    by = [F.coalesce("turn", F.lit(-2 ** 63)), F.col("ha")]
    chunked, cut = ordered.with_chunks(rows, ["conv"], by, hot_rows=HOT_ROWS)
    order = ["turn", "ha", "hb"]
    whole = _joined(_joined(chunked, ["conv", ordered.CHUNK], order), ["conv"], [ordered.CHUNK]) if cut \
        else _joined(rows, ["conv"], order)
    names = ["blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = batch.column(1).to_pylist()
            edits = cheapest_edits(told)
            codes = [np.frombuffer(t.encode(), np.uint8) - ord(LETTERS[0]) for t in told]
            faults = [[int((c & 3 == f).sum()) for c in codes] for f in (BLANK, DUPLICATE, CUT_OFF)]
            pairs = [(c[:-1] >> 2) * 4 + (c[1:] >> 2) for c in codes]
            illegal = [int((~np.isin(p, [1, 6, 9])).sum()) for p in pairs]
            columns = [*faults, illegal, [cost for cost, _ in edits]]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), *[pa.array(c, pa.int64()) for c in columns], pa.array([a for _, a in edits], pa.string())],
                ["conv", *names, "audit"])

    fields = T.StructType([whole.schema["conv"], *[T.StructField(n, T.LongType()) for n in names],
                           T.StructField("audit", T.StringType())])
    found = whole.select("conv", "letters").mapInArrow(run, fields)
    return found.join(gaps, "conv").select("conv.conv_id", "gaps", *names, "audit")


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, edit, role, text) of what stays of the streamed rows, and (conv_id, None, None, None) after each
    conversation.  A conversation's audit comes first, under tag 0."""
    audit, at, state, conv, begun = "", 0, 0, None, False

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while audit[at:at + 1] == "I":
            yield conv, "I", ROLES[state], ""
            state, at = int(NEXT[state]), at + 1

    for batch in batches:
        columns = batch.column(0).field(0).to_pylist(), *(batch.column(i).to_pylist() for i in (1, 5, 6))
        for own, tag, role, text in zip(*columns):
            if tag == 0:
                if begun:
                    yield from inserted()
                    yield conv, None, None, None
                audit, at, state, conv, begun = text, 0, 0, own, True
                continue
            yield from inserted()
            edit, at = audit[at], at + 1
            if edit == "R":
                role, state = ROLES[state], int(NEXT[state])
            elif edit == "K":
                state = int(KEPT["sua".index(role[0]), state])
            if edit != "D":
                yield conv, edit, role, text
    if begun:
        yield from inserted()
        yield conv, None, None, None


def _streamed(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """Each conversation's audit and then its rows in order, a conversation in one partition, sorted and not gathered."""
    rows = _keyed(turns).select("conv", F.lit(1).alias("tag"), "turn", "ha", "hb", "role", "text")
    none = [F.lit(None).cast(rows.schema[n].dataType).alias(n) for n in ("turn", "ha", "hb", "role")]
    heads = audits.select(F.struct("conv_id").alias("conv"), F.lit(0).alias("tag"), *none, F.col("audit").alias("text"))
    return rows.unionByName(heads).repartition("conv").sortWithinPartitions("conv", "tag", "turn", "ha", "hb")


def _as_batches(rows: Iterator[tuple], fields: T.StructType) -> Iterator[pa.RecordBatch]:
    """Batches of at most BATCH_ROWS rows and little more than BATCH_BYTES of text."""
    kinds, held, size = [to_arrow_type(f.dataType) for f in fields], [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], fields.names)

    for row in rows:
        held.append(row)
        size += len(row[-1])
        if len(held) == BATCH_ROWS or size >= BATCH_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def repaired(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """The rows that the audits of `audited(turns)` leave: conv_id, nth (from 0), edit (K, R or I), role, text."""
    bounded_batches(turns.sparkSession)
    fields = T.StructType([audits.schema["conv_id"], *T._parse_datatype_string("nth long, edit string, role string, text string")])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        nth = 0
        for conv, edit, role, text in _told(batches):
            if edit is None:
                nth = 0
            else:
                yield conv, nth, edit, role, text
                nth += 1

    return _streamed(turns, audits).mapInArrow(lambda batches: _as_batches(rows(batches), fields), fields)


def digests(turns: DataFrame, audits: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256: of `role:text` of the repaired rows, joined by line feeds, hashed as they stream by."""
    bounded_batches(turns.sparkSession)
    fields = T.StructType([audits.schema["conv_id"], T.StructField("repaired_sha256", T.StringType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        digest, empty = hashlib.sha256(), True
        for conv, edit, role, text in _told(batches):
            if edit is None:
                yield conv, digest.hexdigest()
                digest, empty = hashlib.sha256(), True
            else:
                digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                empty = False

    return _streamed(turns, audits).mapInArrow(lambda batches: _as_batches(rows(batches), fields), fields)
