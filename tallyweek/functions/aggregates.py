"""Conditional aggregates whose empty sum is 0, as the reports define it.

Spark's own ``sum`` gives NULL when no row qualifies; every report sum is 0 there instead.
All of them are algebraic, so Spark combines them before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sum_or_zero(value: str | Column) -> Column:
    total = F.sum(value)
    return F.coalesce(total, F.lit(0).cast("double"))


def sum_where(value: str | Column, condition: Column) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return sum_or_zero(F.when(condition, column))


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true (NULL counts as not true)."""
    return F.count(F.when(condition, F.lit(1)))


def avg_where(value: str | Column, condition: Column) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.avg(F.when(condition, column))
