"""SimHash near-dedup by the generalised pigeonhole principle.

The 64 bits are cut into groups of correlated bits. Group ``i`` gets a threshold ``t_i`` (-1: not
searched) with ``sum(t_i) = distance - groups + 1``; two fingerprints within the distance then
differ in at most ``t_i`` bits of some group. A dynamic programme picks the thresholds, and with
them the number of groups, that make the expected number of probes and candidates smallest; the
expectation comes from the joint bit counts of all distinct fingerprints.

Defined results: a null text counts as empty; texts without words have fingerprint 0, which links
like any other; rows with equal ids or texts each get their row; a null id never names a component
unless all ids in it are null; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.llm.components import star_components
from tallyweek.llm.shared import landed, landed_observed, portions, text_bytes, tidy, values

BITS = 64
#: Shingles are summed up in portions of this many, which bounds the memory of very long texts.
PORTION = 1 << 16
#: Bytes of texts that are copied out of Arrow at once.
TEXTS = 1 << 21
#: A bucket with more fingerprints is linked through shared neighbours instead of by its pairs.
BUCKET = 128
#: Cost of a probe row against one verified candidate.
PROBE_COST = 4.0


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _pack(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits.astype(np.uint8), axis=1, bitorder="little").view("<u8").ravel()


def simhash_batch(texts: Sequence[bytes], width: int) -> np.ndarray:
    """The fingerprints of UTF-8 texts as unsigned 64-bit numbers."""
    digest = partial(xxhash.xxh64_intdigest, seed=42)
    counts, totals = np.zeros((len(texts), BITS), np.int64), np.zeros(len(texts), np.int64)
    pending: list[tuple[int, np.ndarray]] = []
    size = 0

    def flush() -> None:
        if pending:
            starts = np.cumsum([0, *[len(h) for _, h in pending[:-1]]])
            sums = np.add.reduceat(_bits(np.concatenate([h for _, h in pending])), starts, axis=0, dtype=np.int32)
            np.add.at(counts, [i for i, _ in pending], sums)
            pending.clear()

    for i, text in enumerate(texts):
        words = text.lower().split()  # of bytes: A-Z only, and the six ASCII spaces
        if not words:
            continue
        columns = [words[k:] for k in range(width)] if len(words) >= width else [[w] for w in words]
        shingles = map(b" ".join, zip(*columns))
        hashes = np.fromiter(map(digest, shingles), np.uint64)
        totals[i] = len(hashes)
        for start in range(0, len(hashes), PORTION):
            part = hashes[start : start + PORTION]
            pending.append((i, part))
            size += len(part)
            if size >= PORTION:
                flush()
                size = 0
    flush()
    return _pack(counts * 2 > totals[:, None])


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, fp): the fingerprint of every whole text as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [simhash_batch(texts, width).view(np.int64) for texts in portions(batch.column(1), TEXTS)]
            prints = pa.array(np.concatenate(parts) if parts else [], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), prints], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    return rows.mapInArrow(tidy(run), f"id {kind}, fp bigint")


def joint_bit_counts(prints: DataFrame) -> np.ndarray:
    """How many fingerprints have bits i and j set, over all rows: 64 x 64 numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, PORTION):
                bits = _bits(batch.column(0).to_numpy()[start : start + PORTION]).astype(np.float32)
                total += (bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BITS * BITS, dtype=np.int32)), pa.array(total.ravel())], names=["cell", "n"]
        )

    cells = prints.select("fp").mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(BITS * BITS, np.int64)
    for cell, n in cells.collect():  # 4,096 numbers at any size
        out[cell] = n
    return out.reshape(BITS, BITS)


def correlated_groups(joint: np.ndarray, n: int, groups: int) -> list[list[int]]:
    """Bits in groups of nearly equal size; each grows by the bit most correlated with it."""
    p = np.diag(joint) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs(joint / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    left, out = list(range(BITS)), []
    for g in range(groups):
        size = len(left) // (groups - g)
        pair = max(combinations(left, 2), key=lambda x: corr[x]) if size > 1 else (left[0],)
        group = list(pair)
        rest = [b for b in left if b not in group]
        while len(group) < size:
            best = max(rest, key=lambda b: corr[b, group].mean())
            group.append(best)
            rest.remove(best)
        out.append(group)
        left = rest
    return out


def close_share(joint: np.ndarray, n: int, group: Sequence[int], most: int) -> list[float]:
    """The expected share of pairs that differ in at most 0..most bits of the group.

    The bits are followed as a chain: whether a pair agrees in a bit depends on the one before.
    """
    n = max(n, 1)

    def pair_table(i: int, j: int) -> np.ndarray:
        p11 = joint[i, j] / n
        q = np.array([[1 - joint[i, i] / n - joint[j, j] / n + p11, joint[j, j] / n - p11], [joint[i, i] / n - p11, p11]])
        same, both = (q**2).sum(), 2 * (q[0, 0] * q[1, 1] + q[0, 1] * q[1, 0])
        second = 2 * (q[0, 0] * q[0, 1] + q[1, 0] * q[1, 1])
        return np.array([[same, second], [1 - same - both - second, both]])  # [differs in i][differs in j]

    p = joint[group[0], group[0]] / n
    state = np.zeros((2, most + 2))
    state[0, 0], state[1, 1] = p * p + (1 - p) ** 2, 2 * p * (1 - p)
    for i, j in zip(group, group[1:]):
        table = np.maximum(pair_table(i, j), 0)
        given = table / np.maximum(table.sum(axis=1, keepdims=True), 1e-300)
        moved = np.zeros_like(state)
        for was in (0, 1):
            moved[0] += state[was] * given[was, 0]
            moved[1, 1:] += state[was, :-1] * given[was, 1]
        state = moved
    return list(np.cumsum(state.sum(axis=0))[: most + 1])


def allocate(costs: Sequence[Sequence[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 up, one for each group, with the given sum and the least cost.

    ``costs[i][t + 1]`` is the cost of threshold t in group i.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (value, chosen) in best.items():
            for t, c in enumerate(cost, start=-1):
                if spent + t not in step or value + c < step[spent + t][0]:
                    step[spent + t] = (value + c, [*chosen, t])
        best = step
    return best[total]


def plan_groups(joint: np.ndarray, n: int, distance: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the groups that are searched."""
    plans = []
    for groups in range(2, distance + 4):
        parts = correlated_groups(joint, n, groups)
        costs = []
        for part in parts:
            share = close_share(joint, n, part, distance)
            probes = np.cumsum([comb(len(part), d) for d in range(distance + 1)])
            costs.append([0.0, *[PROBE_COST * n * probes[t] + n * n / 2 * share[t] for t in range(distance + 1)]])
        value, thresholds = allocate(costs, distance - groups + 1)
        plans.append((value, list(zip(parts, thresholds))))
    return [(part, t) for part, t in min(plans, key=lambda x: x[0])[1] if t >= 0]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _flips(bits: Sequence[int], most: int) -> list[int]:
    return [_signed(sum(1 << b for b in chosen)) for d in range(most + 1) for chosen in combinations(bits, d)]


def links(prints: DataFrame, n: int, distance: int) -> DataFrame:
    """Rows (a, b): links that join all distinct fingerprints ``fp`` within the distance.

    Every linked pair is within the distance, and every pair within it is linked directly or
    through others that are. Buckets up to BUCKET rows give their verified pairs. Fingerprints
    that meet a larger bucket are linked through the balls of radius distance/2 around them: two
    fingerprints within an even distance share such a neighbour, and all that share one are
    within the distance, so a star suffices and no bucket is expanded into its pairs.
    """
    if distance % 2:
        raise ValueError("the distance must be even")
    plan = plan_groups(joint_bit_counts(prints), n, distance)
    masks = [_signed(sum(1 << b for b in part)) for part, _ in plan]
    keyed = [F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)]
    index = prints.select("fp", F.explode(F.array(*keyed)).alias("k")).select("fp", "k.*")
    probes = index
    if any(t for _, t in plan):
        flips = F.array(*[F.array(*[F.lit(f) for f in _flips(part, t)]) for part, t in plan])
        probes = index.select("fp", "part", F.explode(flips[F.col("part")]).alias("f"), "key").select(
            "fp", "part", F.col("key").bitwiseXOR(F.col("f")).alias("key")
        )
    bucket = ["part", "key"]
    large = landed(index.groupBy(*bucket).count().where(F.col("count") > BUCKET).select(*bucket), "large-buckets")
    a, b = F.col("fp"), F.col("other")
    some = probes.join(large, bucket, "left_anti").join(
        index.join(large, bucket, "left_anti").withColumnRenamed("fp", "other"), bucket
    )
    pairs = some.where((a < b) & (F.bit_count(a.bitwiseXOR(b)) <= distance)).select(a.alias("a"), b.alias("b"))
    crowd = probes.join(large, bucket, "left_semi").select("fp").distinct()
    ball = F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(f)) for f in _flips(range(BITS), distance // 2)]))
    # A ball holds at most 1 + 64 distinct fingerprints for distance 2, so its list is bounded.
    shared = crowd.select("fp", ball.alias("ball")).groupBy("ball").agg(F.collect_list("fp").alias("fps"))
    stars = shared.where(F.size("fps") > 1).select(F.explode("fps").alias("a"), F.array_min("fps").alias("b"))
    return pairs.union(stars.where("a <> b"))


def near_duplicates(
    docs: DataFrame, width: int = 3, distance: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (id, fp, component): each document with its fingerprint and the smallest id reachable
    by links of at most ``distance`` differing bits."""
    rows = landed(fingerprints(docs, width, id_col, text_col), "simhash")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("first_id"))
    distinct, seen = landed_observed(distinct, "simhash-distinct", n=F.count(F.lit(1)))
    roots = star_components(links(distinct.select("fp"), seen["n"], distance), "a", "b")
    of = distinct.join(roots, distinct.fp == roots.node, "left")
    of = of.select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = of.groupBy("root").agg(F.min("first_id").alias("component"))
    return rows.join(of.join(named, "root").select("fp", "component"), "fp").select("id", "fp", "component")
