"""Change against the previous row of the same entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def change(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[str], columns: Mapping[str, str]
) -> DataFrame:
    """Add ``value - previous value`` for each ``{value column: output name}``.

    The previous row is the one before in ``order`` within ``keys``; the first row has NULL.
    The keys name one entity in one season, so a group holds its calendar weeks: the inputs have
    a row per entity and week (``checks.duplicate_keys`` finds any that do not), and the callers
    key people without an id by name. All lags share one sort.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({out: F.col(value) - F.lag(value, 1).over(window) for value, out in columns.items()})
