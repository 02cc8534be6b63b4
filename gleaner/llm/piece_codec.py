"""SentencePiece encoding and decoding with byte spans into the original text (operator 1).

The text is normalised here: at each position the longest key of the model's compiled character map is replaced, and
for every byte of the normalised text the source byte it comes from is recorded.  The library segments; the lengths of
its pieces, laid end to end over the normalised text, then give every piece its span of original bytes.

Where normalisation changes nothing but spaces and no piece holds a word mark behind another character, words are
segmented independently of each other: each different word is encoded once per worker and remembered.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gleaner.llm.shared import bounded_batches, free_name

MARK = "▁"
#: Words remembered per worker, and the longest that is.
REMEMBERED, LONGEST = 600_000, 96


def _fields(blob: bytes) -> Iterator[tuple[int, bytes | int]]:
    """Fields of a protocol buffer message: number and value."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = blob[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(blob):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        elif key & 7 == 2:
            size = varint()
            yield key >> 3, blob[at:at + size]
            at += size
        else:
            size = {1: 8, 5: 4}[key & 7]
            yield key >> 3, blob[at:at + size]
            at += size


class CharacterMap:
    """The compiled map: the byte size of a double-array trie, the trie, and the replacements, each ended by a zero."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if size else ()
        self.texts = blob[4 + size:]

    @staticmethod
    def _step(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, source: bytes, at: int) -> tuple[int, bytes] | None:
        """Bytes consumed at `at` by the longest key that matches there, and what replaces them."""
        if not self.units:
            return None
        found, node = None, self._step(self.units[0])
        for i in range(at, len(source)):
            node ^= source[i]
            if node >= len(self.units) or self.units[node] & 0x800000FF != source[i]:
                break
            unit = self.units[node]
            node ^= self._step(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.texts[found[1]:self.texts.index(b"\0", found[1])]


class Codec:
    """One model: normaliser with alignment, encoder, decoder."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            blob = f.read()
        self.model = sentencepiece.SentencePieceProcessor(model_proto=blob)
        spec: dict[int, bytes | int] = {}
        trainer: dict[int, bytes | int] = {}
        for number, value in _fields(blob):
            if number in (2, 3):
                (trainer if number == 2 else spec).update(_fields(value))
        self.map = CharacterMap(spec.get(2, b""))
        self.prefix, self.squeeze, self.escape = (bool(spec.get(i, 1)) for i in (3, 4, 5))
        self.suffix_mark = bool(trainer.get(24, 0))
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        is_byte = [self.model.is_byte(i) for i in range(len(pieces))]
        self.lengths = np.array([1 if b else len(p.encode()) for p, b in zip(pieces, is_byte)], np.int64)
        kinds = {self._kind(value) for number, value in _fields(blob) if number == 1}
        self.by_word = (not self.map.units and self.prefix and not self.squeeze and self.escape and not self.suffix_mark
                        and any(is_byte) and 4 not in kinds
                        and not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces))
        self.words: dict[str, bytes] = {}
        self.edges = [np.array([i], "<u4").tobytes() for i in (self.model.bos_id(), self.model.eos_id())]

    @staticmethod
    def _kind(piece: bytes) -> int:
        """1 normal, 2 unknown, 3 control, 4 user defined, 6 byte (fixed values of the format)."""
        return next((v for n, v in _fields(piece) if n == 3), 1)

    def normalise(self, source: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each of them (and the end) the source byte it comes from."""
        space = MARK.encode() if self.escape else b" "
        if not self.map.units and not self.squeeze and self.escape and not self.suffix_mark:
            raw = np.frombuffer(source, np.uint8)
            at = np.repeat(np.arange(len(raw), dtype=np.int32), np.where(raw == 32, 3, 1))
            head = 3 if self.prefix and source else 0
            at = np.concatenate([np.zeros(head, np.int32), at, np.array([len(raw)], np.int32)])
            return (space if head else b"") + source.replace(b" ", space), at
        out, origin, at = [], [], 0
        chunks = []
        while at < len(source):
            hit = self.map.longest(source, at)
            if hit is None:
                head = source[at]
                size = 1 if head < 0x80 else 2 if head < 0xE0 else 3 if head < 0xF0 else 4
                hit = size, source[at:at + size]
            chunks.append((at, *hit))
            at += hit[0]
        if self.squeeze:
            while chunks and chunks[0][2] == b" ":
                chunks.pop(0)
        if not chunks:
            return b"", np.array([len(source)], np.int32)

        def put(text: bytes, source_at: int) -> None:
            out.append(text)
            origin.extend([source_at] * len(text))

        if self.prefix and not self.suffix_mark:
            put(space, chunks[0][0])
        after_space = self.squeeze
        for source_at, _, text in chunks:
            while after_space and text.startswith(b" "):
                text = text[1:]
            if text:
                put(text.replace(b" ", space), source_at)
                after_space = self.squeeze and text.endswith(b" ")
        text = b"".join(out)
        end = len(source)
        if self.squeeze:
            while text.endswith(space):
                text = text[:-len(space)]
                end = origin[len(text)]
                del origin[len(text):]
        if self.prefix and self.suffix_mark:
            text += space
            origin.extend([end] * len(space))
        return text, np.array([*origin, end], np.int32)

    def encode(self, texts: list[str]) -> list[tuple[bytes, np.ndarray | None]]:
        """Ids of each text as little-endian 32-bit integers, without begin and end, and the pieces' lengths in
        normalised bytes (None: those of the vocabulary)."""
        if not self.by_word:
            found = []
            for text in texts:
                pieces = self.model.encode(text, out_type="immutable_proto").pieces
                ids = np.array([p.id for p in pieces], "<u4")
                found.append((ids.tobytes(), np.array(
                    [1 if self.model.is_byte(p.id) else len(p.piece.encode()) for p in pieces], np.int64)))
            return found
        known, found = self.words, []
        if len(known) > REMEMBERED:
            known.clear()
        for text in texts:
            words = self._words(text)
            try:
                found.append((b"".join(map(known.__getitem__, words)), None))
            except KeyError:
                new, once = list(set(words).difference(known)), {}
                plain = [w.replace(MARK, " ") or " " for w in new]
                for word, ids in zip(new, self.model.encode(plain, num_threads=1)):
                    ids = ids if word else self._lone_mark()
                    (known if len(word) <= LONGEST else once)[word] = np.array(ids, "<u4").tobytes()
                both = known | once if once else known
                found.append((b"".join(map(both.__getitem__, words)), None))
        return found

    @staticmethod
    def _words(text: str) -> list[str]:
        """The words of a text, each without the first of the marks before it; marks beyond the first stay."""
        if not text:
            return []
        if MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [w[1:] for w in re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))]

    def _lone_mark(self) -> list[int]:
        """A mark alone: one space after a word gives that word's ids and then these."""
        return self.model.encode("\n ")[len(self.model.encode("\n")):]

    def spans(self, source: bytes, ids: np.ndarray, lengths: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every piece in bytes of the source."""
        normalised, origin = self.normalise(source)
        ends = np.cumsum(self.lengths[ids] if lengths is None else lengths)
        if len(normalised) != (ends[-1] if len(ends) else 0):
            raise ValueError("the pieces do not add up to the normalised text")
        starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        return origin[starts], origin[ends]


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec of a model file."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """The rows with the ids of their whole texts, the byte span of every id in the text, and the text decoded again.

    Adds ids, starts, ends (binary, little-endian 32-bit integers, one per id) and decoded (string); where the rows
    have a column of such a name, the new one gets underscores before it.  Begin and end ids stand at the edges with
    empty spans.  A null text counts as empty: begin and end only.  Repeated rows are encoded alike, an empty table
    gives an empty one, and a text of any length is encoded whole.
    """
    bounded_batches(docs.sparkSession)
    names = []
    for wish in ("ids", "starts", "ends", "decoded"):
        names.append(free_name(docs, wish))
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, T.BinaryType()) for n in names[:3]],
                           T.StructField(names[3], T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        first, last = own.edges
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            columns: list[list] = [[], [], [], []]
            for value, (packed, lengths) in zip(texts, own.encode(texts)):
                source = value.encode()
                ids = np.frombuffer(packed, "<u4")
                starts, ends = own.spans(source, ids, lengths)
                whole = first + packed + last
                zero, size = np.zeros(1, "<i4"), np.array([len(source)], "<i4")
                columns[0].append(whole)
                columns[1].append(np.concatenate([zero, starts, size]).astype("<i4").tobytes())
                columns[2].append(np.concatenate([zero, ends, size]).astype("<i4").tobytes())
                columns[3].append(own.model.decode(np.frombuffer(whole, "<u4").tolist()))
            arrays = [pa.array(c, pa.binary()) for c in columns[:3]] + [pa.array(columns[3], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)


def decode(rows: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """The rows with the text of their packed ids as column `text` (or `_text` ...); null ids decode to the empty text."""
    bounded_batches(rows.sparkSession)
    name = free_name(rows, "text")
    at = rows.columns.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in batches:
            texts = [own.model.decode(np.frombuffer(v or b"", "<u4").tolist()) for v in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())]))
