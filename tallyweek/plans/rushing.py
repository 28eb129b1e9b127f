"""Rushing leaders and rushing by week."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.functions.aggregates import sum_or_zero
from tallyweek.functions.scalars import week_of_game
from tallyweek.operators.entities import bridge_id
from tallyweek.operators.ranking import with_dense_rank


def with_names(totals: DataFrame, players: DataFrame, sums: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Name and position of each rusher, joined to totals instead of plays.

    An id that is listed more than once under one name and position counts as often, as it would
    if every play were joined first; under several names it gives a row for each."""
    names = players.where(F.col("gsis_id").isNotNull()).groupBy("gsis_id", F.col("display_name").alias("name"), "position")
    joined = bridge_id(totals, names.agg(F.count("*").alias("__copies")), "rusher_player_id", "gsis_id")
    copies = F.coalesce("__copies", F.lit(1))
    return joined.withColumns({c: F.col(c) * copies for c in sums}).select("rusher_player_id", "name", "position", *keys, *sums)


def runs(plays: DataFrame) -> DataFrame:
    return plays.where(F.col("play_type") == "run")


def rushing_totals(plays: DataFrame, players: DataFrame) -> DataFrame:
    per_rusher = (
        runs(plays)
        .groupBy("rusher_player_id")
        .agg(
            sum_or_zero("rushing_yards").alias("rushing_yards"),
            F.count("rush_attempt").alias("rush_attempt"),
            sum_or_zero("rush_touchdown").alias("tds"),
            F.countDistinct("game_id").alias("games_played"),
        )
    )
    totals = with_names(per_rusher, players, ["rushing_yards", "rush_attempt", "tds"], ["games_played"])
    return totals.withColumns(
        {
            "ypa": F.try_divide("rushing_yards", "rush_attempt"),
            "tds_per_attempt": F.try_divide("tds", "rush_attempt"),
        }
    )


def rushing_leaders(plays: DataFrame, players: DataFrame, top: int = 50) -> DataFrame:
    """The players with most attempts and their dense rank.

    A leader's rank only depends on attempt counts at or above its own, all of which belong to
    leaders, so ranking the top rows gives the rank among all players.
    """
    leaders = rushing_totals(plays, players).orderBy(F.desc("rush_attempt"), "rusher_player_id").limit(top)
    ranked = with_dense_rank(leaders, [], "rush_attempt", "rank", block_width=1024.0)
    return ranked.select(
        "rank",
        "rusher_player_id",
        "name",
        "position",
        "rush_attempt",
        "ypa",
        "games_played",
        "tds",
        "tds_per_attempt",
    )


def rushing_ranks(plays: DataFrame, players: DataFrame) -> DataFrame:
    """Every rusher with the dense rank of the attempts among all rushers."""
    totals = rushing_totals(plays, players)
    return with_dense_rank(totals, [], "rush_attempt", "rank", block_width=1024.0)


def rushing_by_week(plays: DataFrame, players: DataFrame) -> DataFrame:
    """Attempts and yards per rusher and week, the week taken from the game id."""
    per_week = (
        runs(plays)
        .groupBy("rusher_player_id", week_of_game(F.col("game_id")).alias("week"))
        .agg(F.count("*").alias("attempts"), sum_or_zero("rushing_yards").alias("rushing_yards"))
    )
    return with_names(per_week, players, ["attempts", "rushing_yards"], ["week"])
