"""Ranks and row positions without pulling a whole group into one task.

Groups are cut into (nested) blocks by expressions that lead the order. Rows are placed inside
their block with a window, and the summed size of the blocks before it is added. Blocks are
counted with map-side combination, and each level of blocks is ordered within its parent only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweek.sinks.landing import land


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on keys where NULL equals NULL; the right copies of the keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"__{k}"])
    return left.join(renamed, condition, how).drop(*[f"__{k}" for k in keys])


def _starts(sizes: DataFrame, group: Sequence[str], names: Sequence[str], outs: Sequence[str]) -> DataFrame:
    """Turn block sizes into the size of all blocks before, one level of the names at a time."""
    *prefix, last = names
    before = (
        Window.partitionBy(*group, *prefix)
        .orderBy(F.asc_nulls_first(last))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = {o: F.coalesce(F.sum(o).over(before), F.lit(0)) for o in outs}
    placed = sizes.select(*group, *names, *[c.alias(o) for o, c in starts.items()])
    if not prefix:
        return placed
    parents = _starts(sizes.groupBy(*group, *prefix).agg(*[F.sum(o).alias(o) for o in outs]), group, prefix, outs)
    parents = parents.withColumnsRenamed({o: f"__parent_{o}" for o in outs})
    joined = null_safe_join(placed, parents, [*group, *prefix], "inner")
    return joined.select(*group, *names, *[(F.col(o) + F.col(f"__parent_{o}")).alias(o) for o in outs])


def rows_before(
    df: DataFrame,
    group: Sequence[str],
    blocks: Sequence[tuple[str, Column]],
    order: Sequence[Column],
    outs: Mapping[str, Column],
) -> DataFrame:
    """Add ``{name: summed weight of the rows ordered before a row in its group}``.

    ``blocks`` are (name, ascending sort key) pairs that lead the order; ``order`` sorts a block.
    A weight of 1 counts rows.
    """
    names = [name for name, _ in blocks]
    weighted = df.withColumns({**dict(blocks), **outs})
    inside = Window.partitionBy(*group, *names).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sizes = weighted.groupBy(*group, *names).agg(*[F.sum(o).alias(o) for o in outs])
    starts = _starts(sizes, group, names, list(outs)).withColumnsRenamed({o: f"__start_{o}" for o in outs})
    placed = weighted.withColumns({o: F.coalesce(F.sum(o).over(inside), F.lit(0)) for o in outs})
    joined = null_safe_join(placed, starts, [*group, *names], "inner")
    return joined.withColumns({o: F.col(o) + F.col(f"__start_{o}") for o in outs}).drop(
        *[f"__start_{o}" for o in outs], *[n for n in names if n not in df.columns]
    )


def places_in_order(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], outs: Mapping[str, Column], name: str
) -> DataFrame:
    """``rows_before`` over one global sort: ``{name: summed weight of the rows before a row in its group}``.

    The rows are sorted once by range and landed with the number of their partition, which fixes the
    cut for good. Sums inside a partition, and the sums of the partitions before it, are all that
    is left to add; no task holds more than a partition, whatever the size of a group. Landing runs
    a job when this is called.
    """
    weighted = df.withColumns({f"__{o}": c for o, c in outs.items()})
    ordered = weighted.orderBy(*[F.asc_nulls_first(g) for g in group], *order)
    landed = land(ordered.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), name)
    inside = Window.partitionBy(*group, "__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = landed.groupBy(*group, "__part").agg(*[F.sum(f"__{o}").alias(o) for o in outs])
    starts = parts.select(*group, "__part", *[F.coalesce(F.sum(o).over(earlier), F.lit(0)).alias(f"__start_{o}") for o in outs])
    rows = landed.withColumns({o: F.coalesce(F.sum(f"__{o}").over(inside), F.lit(0)) for o in outs})
    joined = null_safe_join(rows, starts, [*group, "__part"], "inner")
    placed = joined.withColumns({o: F.col(o) + F.col(f"__start_{o}") for o in outs})
    return placed.drop("__part", "__at", *[f"__{o}" for o in outs], *[f"__start_{o}" for o in outs])


def dense_ranks(values: DataFrame, group: Sequence[str], value: str, out: str, block_width: float | None = None) -> DataFrame:
    """Dense rank, highest value first, of each distinct (group, value); NULL values have no rank.

    Equal values collapse before the shuffle, so a group costs what its distinct values cost. With
    ``block_width`` a group of very many values is ordered block by block; without it a group's
    distinct values, which lie on a grid such as points of one game, are ordered at once.
    """
    distinct = values.select(*group, value).where(F.col(value).isNotNull()).distinct()
    if block_width is None:
        rank = F.dense_rank().over(Window.partitionBy(*group).orderBy(F.desc(value)))
        return distinct.withColumn(out, rank.cast("int"))
    ranked = rows_before(
        distinct,
        group,
        blocks=[("__block", -F.floor(F.col(value) / F.lit(block_width)))],
        order=[F.desc(value)],
        outs={"__before": F.lit(1)},
    )
    return ranked.select(*group, value, (F.col("__before") + 1).cast("int").alias(out))


def with_dense_rank(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    out: str,
    shown: Column | None = None,
    block_width: float | None = None,
) -> DataFrame:
    """Attach the dense rank of ``value`` in ``group``; rows where ``shown`` is not true get NULL
    but still take part in the ranking.

    Ranks come back by equality of the values, so ``df`` must give the same bits each time it is
    read: counts, or values from a landed table."""
    ranks = dense_ranks(df, group, value, out, block_width)
    joined = null_safe_join(df, ranks, [*group, value], "left")
    return joined if shown is None else joined.withColumn(out, F.when(shown, F.col(out)))
