"""Removal of long repeated byte strings through enhanced suffix arrays of chosen suffixes.

A full suffix array sorts every position of the corpus. Here only *anchors* are sorted: in every
window of ``length`` bytes the smallest hash of ``gram`` bytes is chosen, so equal windows choose
the same relative place, and each window belongs to exactly one anchor. Anchors with the same gram
form a bucket. Its suffixes are sorted with their common-prefix lengths, a stack scan yields the
intervals of the common-prefix tree, and each interval is split into the groups whose preceding
bytes agree as far as the window needs: the maximal repeats with all their occurrences.

Equal surroundings of an anchor are combined before any text moves, so copies by the thousand
cost one row. A bucket with more than BUCKET different surroundings (one passage in very many
contexts) isn't sorted in one task: its windows are counted by hash instead, spread over all tasks.

Defined results: a null text counts as empty; texts shorter than ``length`` keep everything;
rows with equal texts lose everything if they are long enough; null and repeated ids keep their
rows; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.llm.shared import landed, numbered, portions, text_bytes, tidy, values

LENGTH, GRAM = 400, 64
#: Most different surroundings of one gram that are sorted together: about 5 MB and a few seconds of one task. Counting
#: windows moves some eight times the bytes, so it is left to buckets that one task should not hold.
BUCKET = 8192
#: Window starts of a text that are handled at once; the places of a slice fit PLACE_BITS.
SLICE, PLACE_BITS = 1 << 19, 20
BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(29))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(32))


class Hashes:
    """Hashes of substrings of one byte string: differences of a running sum, moved to place 0."""

    _byte = _mix(np.arange(1, 257, dtype=np.uint64) * _U(BASE))
    _up, _down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        cls, n = Hashes, len(data) + 1
        if len(cls._up) < n:
            size = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                cls._up = np.cumprod(np.concatenate([[_U(1)], np.full(size, BASE, np.uint64)]))
                cls._down = np.cumprod(np.concatenate([[_U(1)], np.full(size, pow(BASE, -1, 1 << 64), np.uint64)]))
        self._sums = np.zeros(n, np.uint64)
        np.cumsum(cls._byte[data] * cls._up[: n - 1], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self._sums[end] - self._sums[start]) * Hashes._down[start] + (end - start).astype(np.uint64))

    def fixed(self, size: int) -> np.ndarray:
        """The hashes of all substrings of one size."""
        n = len(self._sums) - size
        return _mix((self._sums[size:] - self._sums[:n]) * Hashes._down[:n] + _U(size))


def _window_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least value of every window of the width."""
    n = len(x) - width + 1
    blocks = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(x)] = x
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors_of(text: bytes, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(gram hash, surroundings hash, place, first window, last window) of each anchor of a text."""
    data, out = np.frombuffer(text, np.uint8), []
    mask = _U((1 << PLACE_BITS) - 1)
    for begin in range(0, len(data) - length + 1, SLICE):
        part = data[begin : begin + SLICE + length - 1]
        hashes = Hashes(part)
        grams = hashes.fixed(gram)
        least = _window_least((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), length - gram + 1)
        place = (least & mask).astype(np.int64)  # the leftmost of equal hashes
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.concatenate([first[1:], [len(place)]]) - 1
        at = place[first]
        out.append((grams[at], hashes.of(first, last + length), at + begin, first + begin, last + begin))
    if not out:
        return tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out))


def merge_ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open ranges as maximal ranges."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.concatenate([[True], start[1:] > reach[:-1]]) if len(start) else np.empty(0, bool)
    first = np.flatnonzero(new)
    return start[first], reach[np.concatenate([first[1:], [len(start)]]) - 1] if len(start) else reach


_RANGE = pa.struct([("s", pa.int32()), ("e", pa.int32())])
_ANCHOR = pa.struct([("gram", pa.int64()), ("around", pa.int64()), ("place", pa.int32()), ("s", pa.int32()), ("e", pa.int32()), ("times", pa.int32())])
_ANCHOR_TYPE = "struct<gram:bigint,around:bigint,place:int,s:int,e:int,times:int>"
_RANGES_TYPE = "array<struct<s:int,e:int>>"


def _lists(parts: list[tuple[np.ndarray, ...]], kind: pa.StructType) -> pa.ListArray:
    offsets = np.cumsum([0, *[len(p[0]) for p in parts]]).astype(np.int32)
    columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0)] * kind.num_fields
    arrays = [pa.array(c.view(np.int64) if c.dtype == np.uint64 else c).cast(f.type) for c, f in zip(columns, kind)]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(arrays, fields=list(kind)))


def _texts(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """One row per distinct text: its anchors, and the window ranges that repeat inside it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchors, own = [], []
            for text in chain.from_iterable(portions(batch.column(1), SLICE)):
                grams, around, place, first, last = anchors_of(text, length, gram)
                once, index, group, times = np.unique(around, return_index=True, return_inverse=True, return_counts=True)
                own.append(merge_ranges(first[times[group] > 1], last[times[group] > 1] + 1))
                anchors.append((grams[index], once, place[index], first[index], last[index] + 1, times))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(anchors, _ANCHOR), _lists(own, _RANGE)], names=["key", "anchors", "own"])

    scanned = rows.mapInArrow(tidy(run), f"key binary, anchors array<{_ANCHOR_TYPE}>, own {_RANGES_TYPE}")
    return scanned.groupBy("key").agg(F.first("anchors").alias("anchors"), F.first("own").alias("own"), F.count(F.lit(1)).alias("rows"))


def _common(a: bytes, b: bytes) -> int:
    """The length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


def prefix_intervals(lcp: Sequence[int]) -> Iterator[tuple[int, int, int]]:
    """(common prefix, first, last) of every interval of the common-prefix tree, inner ones first.

    ``lcp[i]`` belongs to the suffixes i-1 and i; ``lcp[0]`` isn't used.
    """
    stack = [(0, 0)]
    for i in range(1, len(lcp) + 1):
        here, left = (lcp[i] if i < len(lcp) else -1), i - 1
        while stack and stack[-1][0] > here:
            depth, left = stack.pop()
            if depth:
                yield depth, left, i - 1
        if here >= 0 and (not stack or stack[-1][0] < here):
            stack.append((here, left))


def repeat_groups(rights: Sequence[bytes], lefts: Sequence[bytes], length: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Maximal repeats among suffixes: (common prefix, members, how far back each agrees with another).

    ``lefts`` are the bytes before the suffixes, backwards. A group's members share the prefix and
    at least ``length`` less that many bytes before it.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    lcp = [0, *[_common(rights[a], rights[b]) for a, b in zip(order, order[1:])]]
    by_left = sorted(range(len(lefts)), key=lefts.__getitem__)
    back = np.array([_common(lefts[a], lefts[b]) for a, b in zip(by_left, by_left[1:])], np.int64)
    rank = np.empty(len(lefts), np.int64)
    rank[by_left] = np.arange(len(lefts))
    by_left, order = np.array(by_left), np.array(order)
    for depth, first, last in prefix_intervals(lcp):
        ranks = np.sort(rank[order[first : last + 1]])
        between = np.minimum.reduceat(back[: ranks[-1]], ranks[:-1])
        apart = np.flatnonzero(between < length - depth)  # where the extension to the left differs
        for a, b in zip([0, *(apart + 1)], [*apart, len(between)]):
            if b > a:
                reach = between[a:b]
                best = np.maximum(np.concatenate([[0], reach]), np.concatenate([reach, [0]]))
                yield depth, by_left[ranks[a : b + 1]], best


def _bucket_ranges(members: list[tuple], length: int) -> Iterator[tuple[int, int, int]]:
    """Window ranges (text's row, start, end) of a bucket that occur in more than one of its members.

    A member is (gram, row, place, s, e, single, around bytes); results are for single ones.
    """
    rights = [m[6][m[2] - m[3] :] for m in members]
    lefts = [m[6][: m[2] - m[3]][::-1] for m in members]
    for depth, group, best in repeat_groups(rights, lefts, length):
        for i, back in zip(group.tolist(), best.tolist()):
            _, row, place, s, e, single, _ = members[i]
            start, end = max(s, place - back), min(e, place - (length - depth) + 1)
            if single and end > start:
                yield row, start, end


def _around(compared: DataFrame, length: int) -> DataFrame:
    """The bytes around each anchor that is compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row, text, anchors in values(batch):
                out += [(a["gram"], row, a["place"], a["s"], a["e"], a["single"], text[a["s"] : a["e"] + length - 1]) for a in anchors if not a["crowded"]]
            yield pa.RecordBatch.from_pylist([dict(zip(_MEMBER.names, x)) for x in out], schema=_MEMBER)

    return compared.mapInArrow(tidy(run), "gram bigint, row bigint, place int, s int, e int, single boolean, around binary")


_MEMBER = pa.schema([("gram", pa.int64()), ("row", pa.int64()), ("place", pa.int32()), ("s", pa.int32()), ("e", pa.int32()), ("single", pa.bool_()), ("around", pa.binary())])
_FOUND = pa.schema([("row", pa.int64()), ("s", pa.int32()), ("e", pa.int32())])


def _found(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows) if rows else ([], [], []), _FOUND)], schema=_FOUND)


def _sorted_buckets(members: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket: list[tuple] = []
        for batch in batches:
            found: list[tuple] = []
            for row in values(batch):
                if bucket and bucket[0][0] != row[0]:
                    found += _bucket_ranges(bucket, length)
                    bucket = []
                bucket.append(row)
            yield _found(found)
        yield _found(list(_bucket_ranges(bucket, length)))

    return members.repartition("gram").sortWithinPartitions("gram").mapInArrow(tidy(run), "row bigint, s int, e int")


def _counted_windows(compared: DataFrame, length: int) -> DataFrame:
    """The windows of crowded anchors that occur more than once, by their hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, anchors in values(batch):
                for a in anchors:
                    if a["crowded"]:
                        hashes = Hashes(np.frombuffer(text[a["s"] : a["e"] + length - 1], np.uint8)).fixed(length).view(np.int64)
                        n = len(hashes)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row] * n, pa.int64()), pa.array(np.arange(a["s"], a["e"], dtype=np.int32)), pa.array(hashes), pa.array([0 if a["single"] else 1] * n, pa.int32()), pa.array([a["gram"]] * n, pa.int64())],
                            names=["row", "s", "window", "more", "gram"],
                        )

    windows = compared.mapInArrow(tidy(run), "row bigint, s int, window bigint, more int, gram bigint")
    twice = windows.groupBy("gram", "window").agg(F.count(F.lit(1)).alias("n"), F.sum("more").alias("m")).where("n + m > 1")
    kept = windows.where("more = 0").join(twice.select("gram", "window"), ["gram", "window"], "left_semi")
    return kept.select("row", "s", (F.col("s") + 1).alias("e"))


def _kept(rows: DataFrame, length: int, least_words: int, carried: Sequence[str]) -> DataFrame:
    """The removed spans and the remaining bytes of each row (id, n_bytes, whole, text, ranges, *carried)."""

    def long_enough(text: bytes, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        return np.array([len(text[a:b].split()) >= least_words for a, b in zip(s.tolist(), e.tolist())], bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, kept = [], []
            for n, whole, text, ranges in values(batch.select(["n_bytes", "whole", "text", "ranges"])):
                s = np.array([0] if whole else [r["s"] for r in ranges or ()], np.int64)
                e = np.array([n] if whole else [r["e"] + length - 1 for r in ranges or ()], np.int64)
                s, e = merge_ranges(s, e)
                if least_words and not whole and len(s):
                    stays = long_enough(text, s, e)
                    s, e = s[stays], e[stays]
                spans.append((s, e))
                kept.append(b"" if whole else b"".join(text[a:b] for a, b in zip([0, *e.tolist()], [*s.tolist(), n])))
            more = [batch.column(batch.schema.get_field_index(c)) for c in carried]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), _lists(spans, _RANGE), pa.array(kept, pa.binary()), *more],
                names=["id", "n_bytes", "spans", "kept", *carried],
            )

    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in ("id", "n_bytes", *carried)]
    return rows.mapInArrow(tidy(run), ", ".join([*kinds[:2], f"spans {_RANGES_TYPE}", "kept binary", *kinds[2:]]))


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, least_words: int = 0,
    id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = (),
) -> DataFrame:
    """Rows (id, n_bytes, spans, kept, *keep): per document the removed byte spans [s, e), the rest
    of its bytes, and further columns of the input.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else; of these
    spans, such as hold fewer than ``least_words`` words stay, unless the whole text is a copy.
    """
    carried = [F.col(c).alias(f"__{c}") for c in keep]
    rows = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"), *carried)
    rows = rows.withColumn("key", F.unhex(F.md5("text")))
    keyed = rows.select("key", "text")
    # From here a distinct text goes by its number, which takes less room than its key.
    texts = numbered(_texts(keyed, length, gram), "repeat-anchors")
    anchors = texts.select("row", F.explode("anchors").alias("a")).select("row", "a.*")

    # Equal surroundings: every window of the anchor occurs at each of their places.
    where = F.struct("row", "place", "s", "e")
    around = anchors.groupBy("gram", "around").agg(F.sum("times").alias("n"), F.min(where).alias("at"))
    around = landed(around, "repeat-surroundings")
    equal = anchors.join(around.where("n > 1").select("gram", "around"), ["gram", "around"], "left_semi")

    # Different surroundings of one gram: compared byte by byte, one text for each.
    grams = around.groupBy("gram").agg(F.count(F.lit(1)).alias("different"), F.min("n").alias("least"))
    grams = grams.where("different > 1 AND least = 1").select("gram", (F.col("different") > BUCKET).alias("crowded"))
    compared = around.join(grams, "gram").select("at.row", F.struct("gram", "at.place", "at.s", "at.e", (F.col("n") == 1).alias("single"), "crowded").alias("a"))
    compared = compared.groupBy("row").agg(F.collect_list("a").alias("compared")).join(texts.select("row", "key"), "row")
    whole = keyed.groupBy("key").agg(F.first("text").alias("text"))
    compared = whole.join(compared, "key").select("row", "text", "compared")

    found = equal.select("row", "s", "e").union(_sorted_buckets(_around(compared, length), length)).union(_counted_windows(compared, length))
    found = found.union(texts.select("row", F.explode("own").alias("r")).select("row", "r.*"))
    ranges = found.groupBy("row").agg(F.collect_list(F.struct("s", "e")).alias("ranges"))
    ranges = texts.select("row", "key", "rows").join(ranges, "row", "left")
    # A text of several rows goes whole if it is long enough; its bytes needn't reach those rows.
    n = F.octet_length("text").cast("bigint")
    gone = (F.col("rows") > 1) & (n >= length)
    by_text = whole.join(ranges.select("key", "rows", "ranges"), "key")
    by_text = by_text.select("key", n.alias("n_bytes"), gone.alias("whole"), F.when(~gone, F.col("text")).alias("text"), "ranges")
    more = [f"__{c}" for c in keep]
    joined = rows.select("id", "key", *more).join(by_text, "key").select("id", "n_bytes", "whole", "text", "ranges", *more)
    return _kept(joined, length, least_words, more).withColumnsRenamed(dict(zip(more, keep)))
