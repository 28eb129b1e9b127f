"""Near-duplicate vectors by cross-polytope hashing after fast pseudo-random rotations.

A rotation is three rounds of random signs and a Walsh-Hadamard transform. The hash of a rotated
vector is its largest coordinate with its sign: one of 2d corners. ``hashes`` of them make a
bucket. A vector also joins the buckets of its next best corners (multiprobe), in every one of
``tables`` tables, and all pairs within a bucket are verified by their cosine in double precision.

A pair may meet in several buckets and counts in the smallest one that both have joined, so no
list of pairs is ever shuffled. Equal vectors are combined before hashing. A bucket of more than
BLOCK vectors is cut into blocks; each pair of blocks is verified by a task of its own.

Defined results: null or zero vectors and those with a null, NaN or infinite component link with
nothing, and so do vectors without a label or of another dimension; rows that repeat an id are
vectors of their own; a null id never names a component unless it has no other id; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.llm.components import star_components
from tallyweek.llm.shared import landed, landed_observed, numbered

#: Expected unrelated vectors in a bucket, from which the number of hashes follows.
UNRELATED = 64
BLOCK = 1024


@lru_cache(maxsize=8)
def _signs(size: int, tables: int, hashes: int) -> np.ndarray:
    return np.random.default_rng(7).choice([-1.0, 1.0], (tables, hashes, 3, size))


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row; the length is a power of two."""
    n, size = x.shape
    half = 1
    while half < size:
        x = x.reshape(n, -1, 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return x / np.sqrt(size)


def buckets_of(vectors: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """The bucket numbers of each row of unit vectors: ``probes`` in each of the tables."""
    n, d = vectors.shape
    size = max(2, 1 << (d - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :d] = vectors
    signs, out, rows = _signs(size, tables, hashes), [], np.arange(n)
    for table in range(tables):
        best, costs, swaps = np.zeros(n, np.int64), [], []
        for k in range(hashes):
            y = padded
            for s in signs[table, k]:
                y = hadamard(y * s)
            size_of = np.abs(y)
            top = np.argpartition(-size_of, min(probes, size - 1), axis=1)[:, :probes] if probes < size else np.argsort(-size_of, axis=1)
            top = np.take_along_axis(top, np.argsort(-np.take_along_axis(size_of, top, 1), axis=1, kind="stable"), 1)
            code = 2 * top + (np.take_along_axis(y, top, 1) < 0)
            weight = (2 * size) ** k
            best += code[:, 0] * weight
            # Instead of this hash's best corner another one, at the cost of the smaller coordinate.
            costs.append(size_of[rows, top[:, 0]][:, None] - np.take_along_axis(size_of, top[:, 1:], 1))
            swaps.append((code[:, 1:] - code[:, :1]) * weight)
        cost, swap = np.concatenate(costs, 1), np.concatenate(swaps, 1)
        near = np.argsort(cost, axis=1, kind="stable")[:, : probes - 1]
        chosen = np.concatenate([best[:, None], best[:, None] + np.take_along_axis(swap, near, 1)], 1)
        out.append(chosen + table * (2 * size) ** hashes)
    return np.concatenate(out, 1)


def _matrix(batch_column: pa.Array) -> np.ndarray:
    flat = batch_column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(batch_column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def search_width(n: int, size: int, hashes: int | None, tables: int | None, probes: int | None) -> tuple[int, int, int]:
    """(hashes, tables, probes): enough hashes that few unrelated vectors share a bucket, and with
    each hash more tables and probes, which keep the recall."""
    hashes = hashes or max(2, ceil(log(max(n, 2) / UNRELATED) / log(2 * max(size, 2))))
    return hashes, tables or 2 + 2 * hashes, probes or 4 * (hashes - 1) or 1


_LINKED = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("root", pa.int64())])


def verify_block(reps: np.ndarray, weights: np.ndarray, sides: np.ndarray, joined: np.ndarray, bucket: int, vectors: np.ndarray, cosine: float, cross: bool) -> tuple:
    """(linked rows in all other vectors, smallest-rooted star) of the members of one bucket.

    ``cross``: only pairs of different sides count here; those of one side meet elsewhere.
    """
    unit = _unit(vectors)
    near = unit @ unit.T >= cosine
    np.fill_diagonal(near, False)
    if cross:
        near &= sides[:, None] != sides[None, :]
    a, b = np.nonzero(np.triu(near))
    counts = np.zeros(len(reps), np.int64)
    for start in range(0, len(a), 1 << 16):
        i, j = a[start : start + (1 << 16)], b[start : start + (1 << 16)]
        # Bucket numbers are sorted in each row; the first common one owns the pair.
        both = (joined[i][:, :, None] == joined[j][:, None, :]).any(axis=2) if joined.shape[1] <= 8 else None
        if both is None:
            both = np.zeros((len(i), joined.shape[1]), bool)
            for k in range(joined.shape[1]):
                both |= joined[i] == np.roll(joined[j], k, axis=1)
        first = joined[i, both.argmax(axis=1)]
        own = first == bucket
        np.add.at(counts, i[own], weights[j[own]])
        np.add.at(counts, j[own], weights[i[own]])
    root = np.full(len(reps), -1)
    for start in np.argsort(reps, kind="stable"):
        if root[start] < 0 and near[start].any():
            frontier = np.array([start])
            root[start] = start
            while len(frontier):
                frontier = np.flatnonzero(near[frontier].any(axis=0) & (root < 0))
                root[frontier] = start
    return counts, np.where(root >= 0, reps[root], reps)


def near_vectors(
    table: DataFrame, cosine: float = 0.98, hashes: int | None = None, tables: int | None = None, probes: int | None = None,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Rows (id, n_links, component): for each vector the number of other vectors with its label
    linked to it, and the smallest id reachable by links."""
    names = F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v")
    rows = table.select(*names)
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    # Adding zero makes -0.0 equal to 0.0.
    rows = rows.withColumn("v", F.when(F.col("label").isNotNull() & usable, F.transform("v", lambda x: x + F.lit(0.0))))
    rows = numbered(rows, "vectors")
    same = rows.where("v IS NOT NULL").groupBy("label", "v").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("weight"))
    same, seen = landed_observed(same, "distinct-vectors", n=F.count(F.lit(1)), size=F.max(F.size("v")))
    hashes, tables, probes = search_width(seen["n"], seen["size"] or 1, hashes, tables, probes)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                joined = np.sort(buckets_of(_unit(_matrix(part.column(1))), tables, hashes, probes), axis=1)
                lists = pa.ListArray.from_arrays(np.arange(0, joined.size + 1, joined.shape[1]).astype(np.int32), pa.array(joined.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([int(size)] * len(part), pa.int32()), lists], names=["rep", "size", "joined"])

    joined = same.select("rep", "v").mapInArrow(hashed, "rep bigint, size int, joined array<bigint>")
    members = landed(same.join(joined, "rep"), "vector-buckets")
    place = ["label", "size", "bucket"]
    in_bucket = members.select("rep", "label", "size", F.explode("joined").alias("bucket"))
    counted = in_bucket.groupBy(*place).count().where("count > 1").withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int"))
    in_bucket = in_bucket.join(counted, place).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    in_bucket = in_bucket.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    group = F.xxhash64(*place, low, high)
    meeting = in_bucket.select("rep", F.struct(*place, low.alias("low"), high.alias("high")).alias("at"), "own", group.alias("group"))
    meeting = meeting.join(members.select("rep", "weight", "joined", "v"), "rep")

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            part = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            kept.clear()
            at = part.column("at")[0].as_py()
            reps = part.column("rep").to_numpy()
            counts, root = verify_block(
                reps, part.column("weight").to_numpy(), part.column("own").to_numpy(), _matrix(part.column("joined")).astype(np.int64),
                at["bucket"], _matrix(part.column("v")), cosine, at["low"] != at["high"],
            )
            some = (counts > 0) | (root != reps)
            return pa.RecordBatch.from_arrays([pa.array(reps[some]), pa.array(counts[some]), pa.array(root[some])], schema=_LINKED)

        last = None
        for batch in batches:
            places = batch.column("at").to_pylist()
            start = 0
            for k, here in enumerate(places):
                if here != last:
                    if k > start:
                        kept.append(batch.slice(start, k - start))
                    if kept:
                        yield close()
                    start, last = k, here
            kept.append(batch.slice(start))
        if kept:
            yield close()

    grouped = meeting.repartition("group").sortWithinPartitions("group", "at")
    found = landed(grouped.select("at", "rep", "weight", "own", "joined", "v").mapInArrow(verified, "rep bigint, n bigint, root bigint"), "vector-links")
    roots = star_components(found.where("rep <> root"), "rep", "root")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    of = same.join(counts, "rep", "left").join(roots, same.rep == roots.node, "left")
    of = of.select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    placed = rows.select("id", "label", "v").join(of, ["label", "v"], "left")
    single = F.col("root").isNull()
    named = placed.where(~single).groupBy("root").agg(F.min("id").alias("component"))
    linked = placed.where(~single).join(named, "root").select("id", "n_links", "component")
    return linked.union(placed.where(single).select("id", F.lit(0).cast("bigint"), "id"))
