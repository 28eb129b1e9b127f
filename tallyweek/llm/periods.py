"""Periodic runs of words by block convolution at dyadic scales.

At scale B the text is cut into aligned blocks of B words. The sums of squared differences between a
block and every window that starts B to 2B-1 words later (1 to 15 at the smallest scale, 8) come
from an exact number-theoretic transform: squares of block and window less twice their product. A
sum that is zero modulo the prime is a candidate, its words are compared, and the distance of an
equal window is extended to both sides word by word. A run of period q holds at least 2q places
whose word recurs q later, hence a whole block of the scale of q, so none is missed.

Blocks stay within stretches of words that occur three times or more in their text, outside of
which no run can lie. Blocks of over 2**15 words look through their own first 2**15 words: the
transform has no more places. Distances that are multiples of the period of a run around them are
left out before words are compared.

Defined results: a null text has no words; repeated and null ids keep their rows; other columns are
ignored, whatever their names; an empty table gives an empty result. Words are numbered from 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.llm.shared import values

#: A run has at least so many words, and so many periods.
LEAST_LENGTH, LEAST_PERIODS = 24, 3
SMALLEST = 8
#: A Fermat prime: 2**16 is -1, so a product is reduced by a shift. 3 generates all of its units.
PRIME, GENERATOR = 65537, 3
LONGEST = 1 << 15
#: Places that a batch of transforms holds at most.
PLACES = 1 << 18

Run = tuple[int, int, int]  # start, end (exclusive), period


def reduced(x: np.ndarray) -> np.ndarray:
    """Numbers of less than 2**47 in size, modulo the prime, as numbers of less than 2**32."""
    return (x & 0xFFFF) - (x >> 16)


@cache
def roots(size: int, inverse: bool) -> np.ndarray:
    """The powers 0 to size/2-1 of a root of unity of that order."""
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    return np.array([pow(root, k, PRIME) for k in range(size // 2)], np.int64)


def transform(rows: np.ndarray) -> np.ndarray:
    """The transform of every row, in bit-reversed order; entries between -PRIME and PRIME."""
    size = rows.shape[1]
    span = size
    while span > 1:
        part = rows.reshape(-1, span)
        low, high = part[:, : span // 2], part[:, span // 2 :]
        out = np.empty_like(part)
        out[:, : span // 2] = reduced(low + high)
        out[:, span // 2 :] = reduced(reduced((low - high) * roots(span, False)))
        rows, span = out.reshape(-1, size), span // 2
    return rows


def back(rows: np.ndarray) -> np.ndarray:
    """From bit-reversed order to the original rows, times their size."""
    size = rows.shape[1]
    span = 2
    while span <= size:
        part = rows.reshape(-1, span)
        low, high = part[:, : span // 2], reduced(reduced(part[:, span // 2 :] * roots(span, True)))
        out = np.empty_like(part)
        out[:, : span // 2] = reduced(low + high)
        out[:, span // 2 :] = reduced(low - high)
        rows, span = out.reshape(-1, size), 2 * span
    return rows


def zero_shifts(blocks: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and shift wherever a block (S words) may equal its window (2S words) at a shift below S:
    the sum of squared differences is zero modulo the prime."""
    size = blocks.shape[1]
    padded = np.zeros_like(windows)
    padded[:, 0] = blocks[:, 0]
    padded[:, size + 1 :] = blocks[:, :0:-1]  # reversed around place 0, so that the product correlates
    products = reduced(reduced(transform(padded) * transform(windows)))
    correlation = back(products)[:, :size] * pow(2 * size, -1, PRIME)
    squares = np.cumsum(np.pad(windows * windows, ((0, 0), (1, 0))), axis=1)
    sums = squares[:, size : 2 * size] - squares[:, :size] + (blocks * blocks).sum(axis=1)[:, None]
    return np.nonzero((sums - 2 * correlation) % PRIME == 0)


def equal_stretch(words: np.ndarray, place: int, distance: int, step: int, least: int, most: int) -> int:
    """From a place on, in steps of 1 or -1, how many words equal the ones ``distance`` later,
    looking at places from ``least`` to before ``most``."""
    found, size = 0, 16
    while (size := min(size, most - place - found if step > 0 else place - found - least + 1)) > 0:
        at = place + found if step > 0 else place - found - size + 1
        same = words[at : at + size] == words[at + distance : at + distance + size]
        same = same if step > 0 else same[::-1]
        if not same.all():
            return found + int(same.argmin())
        found, size = found + size, 4 * size
    return found


def without_multiples(places: np.ndarray, distances: np.ndarray, block: int, runs: list[Run]) -> np.ndarray:
    """Which candidates, sorted by place, aren't multiples of the period of a run that holds them."""
    stays = np.ones(len(places), bool)
    for start, end, period in runs:
        a, b = np.searchsorted(places, [start, end])
        inside = places[a:b] + distances[a:b] + block <= end
        stays[a:b] &= ~(inside & (distances[a:b] % period == 0))
    return stays


def is_primitive(words: np.ndarray, start: int, period: int) -> bool:
    """Whether no proper divisor of the period is a period of the words from the start on."""
    for q in range(1, period // 2 + 1):
        if period % q == 0 and np.array_equal(words[start : start + period], words[start + q : start + q + period]):
            return False
    return True


def candidates(words: np.ndarray, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(places, distances, block size) of equal windows at one scale, portion by portion."""
    block = min(scale, LONGEST)
    n = len(words)
    for ahead in range(0 if scale == SMALLEST else scale // block, 2 * scale // block):
        # A window that reaches the end of the text is filled up; matches there are dropped.
        last = n - ahead * block - block
        places = np.arange(0, last + 1, scale)
        for portion in np.array_split(places, -(-len(places) * 2 * block // PLACES) or 1):
            if not len(portion):
                continue
            blocks = words[portion[:, None] + np.arange(block)]
            windows = words[np.minimum(portion[:, None] + ahead * block + np.arange(2 * block), n - 1)]
            row, shift = zero_shifts(blocks % PRIME, windows % PRIME)
            at, distance = portion[row], ahead * block + shift
            fits = (distance > 0) & (at + distance + block <= n)
            yield at[fits], distance[fits], block


def equal_blocks(words: np.ndarray, places: np.ndarray, distances: np.ndarray, block: int) -> np.ndarray:
    """Which candidates are equal word by word."""
    out = np.empty(len(places), bool)
    step = max(1, PLACES // block)
    for i in range(0, len(places), step):
        at = places[i : i + step, None] + np.arange(block)
        out[i : i + step] = (words[at] == words[at + distances[i : i + step, None]]).all(axis=1)
    return out


def runs_of_stretch(words: np.ndarray) -> list[Run]:
    """All runs among the words, given as numbers, by start and period."""
    runs: dict[Run, None] = {}
    scale = SMALLEST
    while LEAST_PERIODS * (1 if scale == SMALLEST else scale) <= len(words) >= LEAST_LENGTH:
        known = [r for r in runs if r[1] - r[0] >= 2 * scale]
        found = []
        for places, distances, block in candidates(words, scale):
            stays = without_multiples(places, distances, block, known)
            places, distances = places[stays], distances[stays]
            stays = equal_blocks(words, places, distances, block)
            found.append((places[stays], distances[stays]))
        places, distances = (np.concatenate(parts) if found else np.empty(0, np.int64) for parts in (zip(*found) if found else ((), ())))
        # Neighbouring blocks at one distance are one stretch; it is extended from its first and last.
        order = np.lexsort((places, distances))
        places, distances = places[order], distances[order]
        joined = (np.diff(places) == scale) & (np.diff(distances) == 0) & (scale <= LONGEST)
        first = np.flatnonzero(np.append(True, ~joined)[: len(places)])
        last = np.append(first[1:] - 1, len(places) - 1)[: len(first)]
        block, reach = min(scale, LONGEST), (0, -1)  # of the distance before: its end of equal words
        for a, b, d in zip(places[first].tolist(), places[last].tolist(), distances[first].tolist(), strict=True):
            if reach[0] == d and a + block <= reach[1]:
                continue
            start = a - equal_stretch(words, a - 1, d, -1, 0, len(words) - d)
            end = b + block + equal_stretch(words, b + block, d, 1, 0, len(words) - d)
            reach = (d, end)
            if end - start + d >= max(LEAST_LENGTH, LEAST_PERIODS * d) and is_primitive(words, start, d):
                runs[start, end + d, d] = None
        scale *= 2
    return sorted(runs, key=lambda r: (r[0], r[2]))


def frequent_stretches(words: np.ndarray) -> Iterator[tuple[int, int]]:
    """Maximal stretches, long enough for a run, of words that each occur three times or more."""
    often = np.bincount(words)[words] >= LEAST_PERIODS
    edges = np.flatnonzero(np.diff(np.concatenate([[False], often, [False]]).astype(np.int8))).reshape(-1, 2)
    yield from ((a, b) for a, b in edges.tolist() if b - a >= LEAST_LENGTH)


def numbers_of(words: list[bytes]) -> np.ndarray:
    """A number for every word: the place of its last occurrence."""
    places = dict(zip(words, range(len(words)), strict=True))
    return np.fromiter(map(places.__getitem__, words), np.int64, len(words))


def find_runs(words: list[bytes]) -> list[Run]:
    """All runs of the words, by start and period."""
    if len(words) < LEAST_LENGTH:
        return []
    numbers = numbers_of(words)
    return [(a + s, a + e, q) for a, b in frequent_stretches(numbers) for s, e, q in runs_of_stretch(numbers[a:b])]


def best_run(runs: list[Run]) -> Run | None:
    """The run with most periods; of equal ones the first, then the one of the smallest period."""
    best = None
    for run in runs:  # by start and period
        start, end, period = run
        if best is None or (end - start) * best[2] > (best[1] - best[0]) * period:
            best = run
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without those that a run holds after its first period."""
    drops, free = [], 0
    for start, end in sorted((start + period, end) for start, end, period in runs):
        drops.append(words[free:start] if start > free else [])
        free = max(free, end)
    return b" ".join(word for kept in [*drops, words[free:]] for word in kept)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n, runs, best, collapsed): number of words, runs as structs (start, length, period)
    by start and period, the one with most periods (null: none), and the text without repeats, its
    words joined by one space."""
    names = ("start", "length", "period")
    plain = lambda run: run and dict(zip(names, (run[0], run[1] - run[0], run[2]), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for (text,) in values(batch.select(["text"])):
                words = text.encode().split() if text else []  # bytes split at ASCII white space only
                runs = find_runs(words)
                out.append((len(words), [plain(r) for r in runs], plain(best_run(runs)), collapsed(words, runs).decode()))
            columns = zip(*out, strict=True) if out else ((),) * 4
            kinds = (pa.int64(), pa.list_(_RUN), _RUN, pa.string())
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["id", "n", "runs", "best", "collapsed"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    one = "struct<start:bigint,length:bigint,period:bigint>"
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n bigint, runs array<{one}>, best {one}, collapsed string")
