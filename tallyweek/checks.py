"""Contracts of the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_KEY = ["season", "week", "team", "gsis_id"]


def duplicate_keys(df: DataFrame, keys: Sequence[str] = tuple(REPORT_KEY)) -> DataFrame:
    """Keys that occur more than once, with their number of rows; NULL ids are not compared."""
    known = df.where(F.col(keys[-1]).isNotNull())
    return known.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def distinct_players(df: DataFrame) -> int:
    """The number of different player names."""
    return df.agg(F.countDistinct("player_name")).first()[0]


def assert_unique(df: DataFrame, keys: Sequence[str] = tuple(REPORT_KEY)) -> None:
    sample = duplicate_keys(df, keys).limit(5).collect()
    if sample:
        raise ValueError(f"rows are not unique on {list(keys)}, for example {sample}")
