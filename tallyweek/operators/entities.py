"""Joining ids, counting appearances, splitting games into sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bridge_id(
    df: DataFrame, players: DataFrame, left: str, right: str, how: str = "left", apart: Sequence[str] = ()
) -> DataFrame:
    """Attach the players' columns through one of their ids; the right id column is dropped.

    No broadcast hint: Spark broadcasts the dimension when its size, estimated or measured at
    run time, is below the threshold, and otherwise joins by sort-merge with skew splitting.

    Rows without an id match nobody, but a sort-merge join would send all of them to one task.
    With ``apart`` they are spread by a digest of these columns, under keys that no id can have.
    """
    renamed = players.withColumnRenamed(right, "__bridge")
    key = F.col(left)
    if apart:
        key = F.coalesce(key, F.concat(F.lit("\u0000"), F.xxhash64(*apart).cast("string")))
    joined = df.withColumn("__key", key).join(renamed, F.col("__key") == F.col("__bridge"), how)
    return joined.drop("__bridge", "__key")


def min_appearances(df: DataFrame, keys: Sequence[str], counted: str, at_least: int) -> DataFrame:
    """Rows of the keys that have at least so many non-NULL ``counted`` values."""
    frequent = df.groupBy(*keys).agg(F.count(counted).alias("__n")).where(F.col("__n") >= at_least).select(*keys)
    return df.join(frequent, on=list(keys), how="left_semi")


def two_sided(games: DataFrame, keep: Sequence[str], home: str, away: str, side: str, other: str) -> DataFrame:
    """Two rows per game, one from each side's point of view, in one pass."""
    sides = F.explode(
        F.array(
            F.struct(F.col(home).alias(side), F.col(away).alias(other)),
            F.struct(F.col(away).alias(side), F.col(home).alias(other)),
        )
    )
    return games.select(*keep, sides.alias("__side")).select(*keep, f"__side.{side}", f"__side.{other}")
