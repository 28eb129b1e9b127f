"""SentencePiece encoding and decoding with weighted finite-state transducers.

Three transducers are compiled from a model file: the normaliser (a dummy prefix, and spaces as the
piece alphabet's mark), the pieces (a path of characters for each, ending in its id), and the byte
fallback (a character without a piece becomes its UTF-8 bytes' pieces). An input is composed with
them into a lattice whose states are places of the text, and the shortest path in the tropical
semiring (sum along a path, least over paths) is the encoding.

Weights of a unigram model are the negated scores. A merging (BPE) model has no additive scores: a
path is its result exactly if no two neighbouring pieces would have merged differently. So its
lattice is composed with one more automaton, over pairs of neighbours, with weight 0 for pairs that
keep apart and infinity for others; one path of finite weight remains, and it is the shortest.

Pieces don't span units (spaces with the word after them, or line ends), so a unit is encoded once and
remembered, within a bound. Defined results: a null text counts as empty and has no ids; repeated and
null ids keep their rows; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator, Sequence
from functools import lru_cache
from math import inf
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Units, their stems, and pairs of pieces that a Python worker remembers; beyond it each memory starts anew.
REMEMBERED = 500_000
#: Fixed values of the model format.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
_MARKS = ".,!?;:#$%&*"


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a protocol-buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value, shift, at = value | (byte & 127) << shift, shift + 7, at + 1
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        elif key & 7 == 5:
            value, at = struct.unpack_from("<f", data, at)[0], at + 4
        elif key & 7 == 1:
            value, at = struct.unpack_from("<d", data, at)[0], at + 8
        else:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


class Transducer:
    """The compiled model; ``encode`` composes it with an input, ``decode`` inverts it."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            message = list(_fields(file.read()))
        self.names: list[str] = []
        self.weights: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self._bytes: dict[int, int] = {}
        self._text: list[bytes] = []
        for number, value in message:
            if number != 1:
                continue
            piece = dict(_fields(value))
            name, kind, i = piece[1].decode(), piece.get(3, NORMAL), len(self.names)
            self.names.append(name)
            if kind == BYTE:
                self._bytes[int(name[3:5], 16)] = i
                self._text.append(bytes([int(name[3:5], 16)]))
            else:
                self._text.append(b"" if kind in (CONTROL, UNKNOWN) else name.replace(MARK, " ").encode())
                self._unknown = i if kind == UNKNOWN else getattr(self, "_unknown", 0)
            if kind in (NORMAL, USER):
                self.ids[name], self.weights[name] = i, -piece.get(2, 0.0)
        trainer = dict(_fields(next(v for n, v in message if n == 2)))
        normaliser = dict(_fields(next(v for n, v in message if n == 3)))
        self.kind = trainer.get(3, UNIGRAM)
        if normaliser.get(2) or not normaliser.get(5, 1) or self.kind not in (UNIGRAM, BPE):
            raise ValueError("only identity normalisers with marked spaces, and unigram or merging models, are compiled")
        self._prefix = MARK if normaliser.get(3, 1) else ""
        self._squeeze = bool(normaliser.get(4, 1))
        self.longest = max(map(len, self.ids))
        inner = any(MARK in n.lstrip(MARK) or ("\n" in n and len(n) > 1) for n in self.ids)
        self._unit = re.compile(rf"(?s).+" if inner else rf"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
        self._known: dict[str, bytes] = {}
        self._stems: dict[str, bytes] = {}
        self._pairs: dict[int, bool] = {}
        # A place between two characters that no piece has side by side is in no piece.
        self._touching = {a + b for n in self.ids for a, b in zip(n, n[1:])}

    def normalise(self, text: str) -> str:
        if self._squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        return self._prefix + text.replace(" ", MARK) if text else ""

    def _merged(self, text: str) -> list[str]:
        """The result of merging neighbours, least weight and leftmost first."""
        parts, weights = list(text), self.weights
        costs = [weights.get(a + b, inf) for a, b in zip(parts, parts[1:])]
        while costs and (least := min(costs)) < inf:
            k = costs.index(least)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
            del costs[k]
            if k < len(costs):
                costs[k] = weights.get(parts[k] + parts[k + 1], inf)
            if k:
                costs[k - 1] = weights.get(parts[k - 1] + parts[k], inf)
        return parts

    def _stay_apart(self, key: int, a: str, b: str) -> bool:
        """Whether two pieces side by side stay as they are."""
        if len(self._pairs) >= REMEMBERED:
            self._pairs.clear()
        found = self._pairs[key] = self._merged(a + b) == [a, b]
        return found

    def _weighted_path(self, unit: str) -> list[int]:
        """The first places of the pieces on the path of least summed weights."""
        n, weights = len(unit), self.weights
        cost, back = [0.0] + [inf] * n, [0] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                arc = weights.get(unit[start:end])
                if arc is None:
                    if end - start > 1:
                        continue
                    arc = 1e3  # a character without a piece: its bytes
                if cost[start] + arc < cost[end]:
                    cost[end], back[end] = cost[start] + arc, start
        return back

    def _apart_path(self, unit: str) -> list[int]:
        """The same with weights on pairs of neighbours, 0 or infinite: exactly one path to each
        place has a finite weight, so the first one found is the least."""
        n, ids, longest, pairs = len(unit), self.ids, self.longest, self._pairs
        back, last = [0] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            for start in range(end - longest if end > longest else 0, end):
                piece = ids.get(unit[start:end])
                if piece is None:
                    if start < end - 1:
                        continue
                    piece = len(self.names) + ord(unit[start])  # a character without a piece
                if start:
                    key = last[start] << 21 | piece
                    apart = pairs.get(key)
                    if apart is None:
                        apart = self._stay_apart(key, unit[back[start] : start], unit[start:end])
                    if not apart:
                        continue
                back[end], last[end] = start, piece
                break
        return back

    def shortest_path(self, unit: str) -> list[str]:
        """The pieces on the shortest path through the unit's lattice."""
        back = self._apart_path(unit) if self.kind == BPE else self._weighted_path(unit)
        out, n = [], len(unit)
        while n:
            out.append(unit[back[n] : n])
            n = back[n]
        return out[::-1]

    def _coded(self, unit: str) -> bytes:
        ids: list[int] = []
        for piece in self.shortest_path(unit):
            if piece in self.ids:
                ids.append(self.ids[piece])
            elif self._bytes:
                ids += [self._bytes[b] for b in piece.encode()]
            else:
                ids.append(self._unknown)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _stem(self, stem: str) -> bytes:
        found = self._stems.get(stem)
        if found is None:
            if len(self._stems) >= REMEMBERED:
                self._stems.clear()
            found = self._stems[stem] = self._coded(stem)
        return found

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        known, out = self._known, []
        for unit in self._unit.findall(self.normalise(text)):
            found = known.get(unit)
            if found is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                n = len(unit.rstrip(_MARKS))
                if 0 < n < len(unit) and unit[n - 1 : n + 1] not in self._touching:
                    found = self._stem(unit[:n]) + self._stem(unit[n:])
                else:
                    found = self._stem(unit)
                known[unit] = found
            out.append(found)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        data = b"".join(map(self._text.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return data.decode("utf-8", "replace").removeprefix(" " if self._prefix else "")


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, ids array<int>) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = [np.frombuffer(transducer(model).encode(t), "<u4").astype(np.int32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(coded, pa.list_(pa.int32()))], names=["id", "ids"])

    return _rows(docs, id_col, text_col).mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, ids array<int>")


def decode(coded: DataFrame, model: str) -> DataFrame:
    """Rows (id, text) from rows (id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [transducer(model).decode(np.array(ids or [], "<u4").tobytes()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return coded.select("id", "ids").mapInArrow(run, f"id {coded.schema['id'].dataType.simpleString()}, text string")


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_ids, ids_crc32, restored): encoded and decoded again in one pass; ``restored``
    says that the decoded text is the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, bool]] = []
            for text in batch.column(1).to_pylist():
                ids = transducer(model).encode(text)
                out.append((len(ids) // 4, crc32(ids), transducer(model).decode(ids) == text))
            n, crc, same = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())], names=["id", "n_ids", "ids_crc32", "restored"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return _rows(docs, id_col, text_col).mapInArrow(run, f"id {kind}, n_ids bigint, ids_crc32 bigint, restored boolean")
