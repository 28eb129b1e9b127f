"""Complete period grids: every period between an entity's first and last appearance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyweek.operators.counted import Counter, uncounted
from tallyweek.operators.lookup import scalar_map


def calendar_map(df: DataFrame, season: str, period: str) -> Column:
    """Season -> sorted periods that occur in it.

    Its size is the calendar's (a few dozen integers per season), whatever the number of rows:
    the distinct set is built before the shuffle.
    """
    per_season = (
        df.where(F.col(season).isNotNull() & F.col(period).isNotNull())
        .groupBy(season)
        .agg(F.sort_array(F.collect_set(period)).alias("periods"))
    )
    return scalar_map(per_season, season, "periods")


def spans_of(df: DataFrame, keys: Sequence[str], labels: Sequence[str], period: str) -> DataFrame:
    """First and last period of each (keys, labels)."""
    return df.groupBy(*keys, *labels).agg(F.min(period).alias("first_period"), F.max(period).alias("last_period"))


def with_known_labels(spans: DataFrame, keys: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Add ``known_<label>``: the label, and where it is NULL the first one known of the keys, by
    period and labels. A group holds one span for each spelling of an entity."""
    group = Window.partitionBy(*keys)
    first = {
        label: F.min(F.when(F.col(label).isNotNull(), F.struct("first_period", *labels))).over(group)[label]
        for label in labels
    }
    return spans.withColumns({f"known_{label}": F.coalesce(label, c) for label, c in first.items()})


def period_grid(df: DataFrame, keys: Sequence[str], labels: Sequence[str], season: str, period: str) -> DataFrame:
    """One row per (keys, labels) and each calendar period between first and last appearance.

    ``keys`` must contain ``season``.
    """
    return _grid(spans_of(df, keys, labels, period), df, season, period)


def _grid(spans: DataFrame, df: DataFrame, season: str, period: str) -> DataFrame:
    """The spans' columns, and a row per calendar period of each."""
    columns = [c for c in spans.columns if c not in ("first_period", "last_period")]
    periods = F.try_element_at(calendar_map(df, season, period), F.col(season))
    within = F.filter("__periods", lambda p: p.between(F.col("first_period"), F.col("last_period")))
    return spans.withColumn("__periods", periods).select(*columns, F.explode(within).alias(period))


def gap_fill(
    df: DataFrame,
    keys: Sequence[str],
    labels: Sequence[str],
    season: str,
    period: str,
    fills: Mapping[str, object],
    counted: Counter = uncounted,
    known: Sequence[str] = (),
) -> DataFrame:
    """The period grid with the observed measures; periods without an observation get ``fills``.
    Labels in ``known`` also come as ``known_<label>``, filled among the labels' spans.

    Grid and observations meet on ``keys``, so a later window over ``keys`` needs no further
    shuffle when ``spark.sql.requireAllClusterKeysForCoPartition`` is off. The repartition takes the
    join out of skew splitting, so the keys must name one entity of a season: a group then holds
    its weeks only, and no key can be hot.
    """
    # Spans are moved, not the longer grid.
    spans = counted("spans", spans_of(df, keys, labels, period)).repartition(*keys)
    grid = _grid(with_known_labels(spans, keys, known) if known else spans, df, season, period)
    observed = df.select(*keys, period, *fills)
    filled = grid.join(observed, on=[*keys, period], how="left")
    return filled.withColumns({name: F.coalesce(F.col(name), F.lit(value)) for name, value in fills.items()})
