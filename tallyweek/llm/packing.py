"""Bulk-synchronous best-fit packing of token pieces into sequences of a fixed capacity.

A round takes all pieces not yet placed and all open gaps:

1. Both are range-sorted by size, so that a partition holds the pieces and gaps of one size range.
2. Every partition sweeps its sizes upwards. A gap meets the unplaced pieces below it, takes its
   predecessor among them (the piece whose successor it is), and the next ones for the room that
   is left. Pieces larger than every open gap open new sequences, largest first, each filled with
   the largest pieces of that zone that still fit. Only the upper half of the sizes opens at once,
   so that smaller pieces stay to fill what those leave; where those are many more tokens, the sizes
   that hold the upper half of all tokens do, as long as the open gaps need no more than the rest.
3. What is left over in a partition has only its rank there. The counts per partition (a few
   numbers each, a row that its sweep writes) are matched from the smallest gaps up, and pieces and
   gaps with conflicting wishes meet by their ranks, in one aggregation by gap.
4. Gaps shrink by what they took, and the next round begins, until no piece is left. The last
   LAST_ROWS rows are one size range, for which one task runs the remaining rounds.

Every round places something, and a gap is filled at least by half of what fits, so the number of
rounds grows with the logarithm of the capacity, not with the rows; a table of mostly short pieces
loses half of its tokens in a round that opens sequences, so that few rounds move all of them.

Defined results: a null text counts as empty and still gives the end token; repeated and null ids
keep their rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweek.llm.shared import landed, landed_observed, numbered, portions, text_bytes, tidy, values
from tallyweek.llm.tokens import PORTION, TEXTS, word_encoder

CAPACITY, END_TOKEN = 4096, 1
#: Rows swept by one task, partitions of a sweep where rows are fewer, and rows that one task packs to the end.
TASK_ROWS, LEAST_TASKS, LAST_ROWS = 200_000, 8, 4_000
#: Classes of sizes, by powers of two, whose tokens are counted.
CLASSES = 16

_PIECES = "id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_token: int = END_TOKEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, piece, start, length, ids_crc32): the ids of each text and an end token, cut
    into pieces of at most the capacity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_encoder(tokenizer), np.array([end_token], "<u4").tobytes()
        for batch in batches:
            out = []
            coded = chain.from_iterable(map(encoder.encode, portions(batch.column(1), PORTION, TEXTS)))
            for i, ids in zip(batch.column(0), coded):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    out.append((i.as_py(), k, at // 4, len(part) // 4, crc32(part)))
            columns = list(zip(*out)) or [()] * 5
            kinds = [batch.schema.types[0], pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["id", "piece", "start", "length", "ids_crc32"]
            )

    rows = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    return rows.mapInArrow(tidy(run), _PIECES.format(kind=docs.schema[id_col].dataType.simpleString()))


#: Kinds of rows; of a COUNTED one item, size, seq and rank are the pieces left, the largest, the gaps left and the smallest.
PIECE, GAP, PLACED, COUNTED = range(4)
_STATE = "kind int, item bigint, size int, seq bigint"
_SWEPT = pa.schema([("kind", pa.int32()), ("item", pa.int64()), ("size", pa.int32()), ("seq", pa.int64()), ("part", pa.int32()), ("rank", pa.int64())])


def sweep(sizes: list[int], kinds: list[int], items: list[int], capacity: int, largest_gap: int, opens_from: int) -> list[tuple[int, int, int, int]]:
    """One partition's sweep over rows sorted by size, pieces before gaps: (kind, item, size, seq)
    of placed pieces, then of remaining pieces and gaps in ascending size."""
    low_sizes: list[int] = []
    low: list[int] = []
    out, gaps, opening = [], [], []
    for size, kind, item in zip(sizes, kinds, items):
        if kind == PIECE:
            if size > largest_gap and size >= opens_from:
                opening.append((size, item))
            else:
                low_sizes.append(size)
                low.append(item)
            continue
        room = size
        while low_sizes and (k := bisect_right(low_sizes, room) - 1) >= 0:
            room -= low_sizes[k]
            out.append((PLACED, low.pop(k), low_sizes.pop(k), item))
        if room:
            gaps.append((room, item))
    zone_sizes, zone = [s for s, _ in opening], [i for _, i in opening]
    while zone:
        seq, room = zone[-1], capacity
        while zone and (k := bisect_right(zone_sizes, room) - 1) >= 0:
            room -= zone_sizes[k]
            out.append((PLACED, zone.pop(k), zone_sizes.pop(k), seq))
        if room:
            gaps.append((room, seq))
    out += [(PIECE, i, s, -1) for s, i in zip(low_sizes, low)]
    return out + [(GAP, i, s, i) for s, i in sorted(gaps)]


def match_leftovers(parts: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Ranks of gaps matched with ranks of pieces, over partitions in ascending size.

    ``parts``: (partition, pieces, largest piece, gaps, smallest gap). A result (gap partition,
    first gap, gaps, piece partition, first piece, pieces per gap) gives each gap as many pieces
    as surely fit; pieces are taken from their upper end, the nearest sizes below a gap first.
    """
    open_pieces: list[list[int]] = []  # [partition, pieces left, largest]
    out = []
    for part, n_pieces, largest, n_gaps, smallest in parts:
        taken = 0
        # A partition's own pieces lie between its gaps in size; they join after its gaps are served.
        while taken < n_gaps and open_pieces:
            source = open_pieces[-1]
            each = max(1, smallest // source[2]) if source[2] <= smallest else 0
            if not each:
                break
            served = min(n_gaps - taken, -(-source[1] // each))
            count = min(source[1], served * each)
            source[1] -= count
            out.append((part, taken, served, source[0], source[1], each))
            taken += served
            if not source[1]:
                open_pieces.pop()
        if n_pieces:
            open_pieces.append([part, n_pieces, largest])
    return out


def opening(measured: dict) -> tuple[int, int]:
    """(largest gap that keeps pieces from opening, smallest size that opens) of a round with these ``_measures``."""
    upper, tokens = measured["largest_piece"] // 2 + 1, measured["tokens"]
    halves = [2**k for k in range(CLASSES) if 2 * measured[f"tokens_{k}"] >= tokens]
    enough = max(halves, default=1)
    # The gaps' room is left to pieces that don't open: those have half of the tokens less one class of sizes.
    rest = tokens - measured[f"tokens_{enough.bit_length() - 1}"]
    if enough < upper and measured["room"] <= rest:
        return 0, enough
    return measured["largest_gap"] or 0, upper


def _round(state: DataFrame, capacity: int, rows: int, largest_gap: int, opens_from: int) -> DataFrame:
    tasks = max(LEAST_TASKS, -(-rows // TASK_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns: list[list] = [[], [], []]
        for batch in batches:
            for column, more in zip(columns, batch.columns):
                column += more.to_pylist()
        part = TaskContext.get().partitionId()
        out = sweep(*columns, capacity, largest_gap, opens_from)
        rank = {PLACED: 0, PIECE: 0, GAP: 0}
        ranked = []
        for kind, item, size, seq in out:
            ranked.append((kind, item, size, seq, part, rank[kind]))
            rank[kind] += 1
        largest = max((size for kind, _, size, _ in out if kind == PIECE), default=0)
        smallest = min((size for kind, _, size, _ in out if kind == GAP), default=0)
        ranked.append((COUNTED, rank[PIECE], largest, rank[GAP], part, smallest))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*ranked), _SWEPT)], schema=_SWEPT)

    # The item makes equal sizes divisible over partitions.
    dealt = state.repartitionByRange(tasks, "size", "kind", "item").sortWithinPartitions("size", "kind", "item")
    return dealt.select("size", "kind", "item").mapInArrow(run, f"{_STATE}, part int, rank bigint")


def _finish(state: DataFrame, capacity: int) -> DataFrame:
    """The remaining rounds over rows that one task may hold: there is one size range, whose sweep
    leaves nothing to match across partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        placed: list[tuple] = []
        while any(kind == PIECE for _, kind, _ in rows):
            largest_gap = max((size for size, kind, _ in rows if kind == GAP), default=0)
            largest_piece = max(size for size, kind, _ in rows if kind == PIECE)
            out = sweep(*map(list, zip(*rows)), capacity, largest_gap, largest_piece // 2 + 1)
            placed += [r for r in out if r[0] == PLACED]
            rows = sorted((size, kind, item) for kind, item, size, _ in out if kind != PLACED)
        kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64()]
        columns = zip(*placed) if placed else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["kind", "item", "size", "seq"])

    return state.select("size", "kind", "item").coalesce(1).mapInArrow(run, _STATE)


def _meet(swept: DataFrame, matches: list[tuple]) -> DataFrame:
    """The rows after a round: leftover pieces placed by their ranks, gaps less what they took.

    ``matches``: (kind, partition, first rank, rank after the last, pieces per gap, number of the match)."""
    # Two rows for each match, of which there are at most two for each partition of the sweep.
    table = swept.sparkSession.createDataFrame(matches, "of_kind int, of_part int, begin bigint, end bigint, each bigint, of int")
    meant = (F.col("kind") == F.col("of_kind")) & (F.col("part") == F.col("of_part")) & (F.col("rank") >= F.col("begin")) & (F.col("rank") < F.col("end"))
    is_piece = F.col("kind") == PIECE
    # The largest pieces go to the first gaps, which are the smallest and fit them all.
    turn = F.when(is_piece, F.floor((F.col("end") - 1 - F.col("rank")) / F.col("each"))).otherwise(F.col("rank") - F.col("begin"))
    placed = swept.where(F.col("kind") == PLACED).select("kind", "item", "size", "seq")
    rows = swept.where(F.col("kind") < PLACED).join(F.broadcast(table), meant, "left").withColumn("turn", turn)
    # A gap takes as many pieces as it has tokens at most.
    gaps = rows.where("of IS NOT NULL").groupBy("of", "turn").agg(
        F.max(F.when(~is_piece, F.col("seq"))).alias("seq"), F.max(F.when(~is_piece, F.col("size"))).alias("room"),
        F.collect_list(F.when(is_piece, F.struct("item", "size"))).alias("pieces"), F.sum(F.when(is_piece, F.col("size"))).alias("took"),
    )
    seq = F.col("seq").alias("seq")
    took = F.transform("pieces", lambda p: F.struct(F.lit(PLACED).alias("kind"), p["item"].alias("item"), p["size"].alias("size"), seq))
    rest = F.struct(F.lit(GAP).alias("kind"), F.col("seq").alias("item"), (F.col("room") - F.coalesce("took", F.lit(0))).cast("int").alias("size"), seq)
    met = gaps.select(F.inline(F.concat(took, F.array(rest))))
    return placed.union(rows.where("of IS NULL").select("kind", "item", "size", "seq")).union(met.where("size > 0"))


def _measures() -> dict:
    piece, gap = F.col("kind") == PIECE, F.col("kind") == GAP
    return {
        "pieces": F.count(F.when(piece, 1)),
        "rows": F.count(F.when(piece | gap, 1)),
        "largest_piece": F.max(F.when(piece, F.col("size"))),
        "largest_gap": F.max(F.when(gap, F.col("size"))),
        "room": F.coalesce(F.sum(F.when(gap, F.col("size"))), F.lit(0)),
        "tokens": F.coalesce(F.sum(F.when(piece, F.col("size"))), F.lit(0)),
        # Tokens of the pieces of at least 2**k tokens.
        **{f"tokens_{k}": F.coalesce(F.sum(F.when(piece & (F.col("size") >= 2**k), F.col("size"))), F.lit(0)) for k in range(CLASSES)},
    }


def best_fit(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Rows (item, seq, size) for items (item bigint unique, size int from 1 to the capacity).

    A sequence is named by the item that opened it."""
    full = items.where(F.col("size") == capacity).select("item", F.col("item").alias("seq"), "size")
    state = items.where(F.col("size") < capacity).select(F.lit(PIECE).alias("kind"), "item", "size", F.lit(-1).cast("bigint").alias("seq"))
    measured = state.agg(*[c.alias(n) for n, c in _measures().items()]).first().asDict()
    placed = [full]
    while measured["rows"] > LAST_ROWS and measured["pieces"]:
        swept = landed(_round(state, capacity, measured["rows"], *opening(measured)), "packing-sweep")
        counted = swept.where(F.col("kind") == COUNTED).select("part", "item", "size", "seq", "rank")
        parts = sorted(tuple(r) for r in counted.collect())  # a row per partition of the sweep
        matches, top = [], {p[0]: p[1] for p in parts}
        for k, (gap_part, first_gap, n_gaps, piece_part, first_piece, each) in enumerate(match_leftovers(parts)):
            matches.append((PIECE, piece_part, first_piece, top[piece_part], each, k))
            matches.append((GAP, gap_part, first_gap, first_gap + n_gaps, 1, k))
            top[piece_part] = first_piece
        rows = _meet(swept, matches) if matches else swept.where(F.col("kind") != COUNTED).select("kind", "item", "size", "seq")
        rows, measured = landed_observed(rows, "packing-round", **_measures())
        placed.append(rows.where(F.col("kind") == PLACED).select("item", "seq", "size"))
        state = rows.where(F.col("kind") != PLACED)
    if measured["pieces"]:
        last = landed(_finish(state, capacity), "packing-last")
        placed.append(last.select("item", "seq", "size"))
    out = placed[0]
    for more in placed[1:]:
        out = out.union(more)
    return out


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_token: int = END_TOKEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, piece, start, length, ids_crc32, sequence_id, offset): every piece with its place."""
    cut = pieces(docs, tokenizer, capacity, end_token, id_col, text_col)
    cut = numbered(cut, "packing-pieces").withColumnRenamed("row", "item")
    placed = best_fit(cut.select("item", F.col("length").cast("int").alias("size")), capacity)
    # A sequence holds at most `capacity` pieces, as each has a token at least.
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "item").rowsBetween(Window.unboundedPreceding, -1)
    rows = cut.join(placed.select("item", F.col("seq").alias("sequence_id")), "item")
    rows = rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return rows.select("id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
