"""Long to wide and first-cell rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def periods_of(df: DataFrame, period: str) -> list[int]:
    """The sorted distinct periods: one integer per calendar week, needed as column names."""
    return sorted(row[0] for row in df.select(period).where(F.col(period).isNotNull()).distinct().collect())


def first_cells(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per key: all values of its first row in ``order``."""
    first = F.min_by(F.struct(*values), F.struct(*order)).alias("__first")
    return df.groupBy(*keys).agg(first).select(*keys, "__first.*")


def pivot_period(df: DataFrame, rows: Sequence[str], period: str, periods: Sequence[int], value: str) -> DataFrame:
    """Periods become columns ``week_<n>``; a missing cell is NULL."""
    wide = df.groupBy(*rows).pivot(period, list(periods)).agg(F.first(value))
    return wide.withColumnsRenamed({str(p): f"week_{p}" for p in periods})
