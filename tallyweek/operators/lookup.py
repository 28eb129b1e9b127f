"""Small per-group facts as a literal map instead of a join on a few hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar_map(df: DataFrame, key: str, value: str) -> Column:
    """``key -> value`` of an aggregated frame as a one-row scalar subquery.

    For frames with one row per season (times a fixed number of metrics), where a join would
    send all rows of the big side to a handful of partitions.
    """
    return df.agg(F.map_from_entries(F.collect_list(F.struct(key, value))).alias("lookup")).scalar()
