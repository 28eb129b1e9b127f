"""Team-level facts from plays: games, targets, dropbacks, opponents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyweek.functions.aggregates import sum_or_zero
from tallyweek.operators.entities import two_sided


def _dropback_sum():
    return sum_or_zero("pass_attempt") + sum_or_zero("sack") + sum_or_zero("qb_scramble")


def team_dropbacks(plays: DataFrame) -> DataFrame:
    """Pass attempts, sacks and scrambles of a team in a week, added up."""
    weekly = plays.groupBy("season", "week", F.col("posteam").alias("team"))
    return weekly.agg(_dropback_sum().alias("team_dropbacks"))


def team_game_ids(plays: DataFrame) -> DataFrame:
    return plays.select("game_id", "season", "week", F.col("posteam").alias("team")).distinct()


def team_games_with_dropbacks(plays: DataFrame) -> DataFrame:
    """Game ids of a team-week with the week's dropbacks, from one scan of the plays.

    After the aggregation a team-week holds one row per game, so the window groups are tiny.
    """
    games = plays.groupBy("season", "week", F.col("posteam").alias("team"), "game_id").agg(
        _dropback_sum().alias("game_dropbacks")
    )
    week = Window.partitionBy("season", "week", "team")
    return games.select(
        "season", "week", "team", "game_id", F.sum("game_dropbacks").over(week).alias("team_dropbacks")
    )


def team_targets(plays: DataFrame) -> DataFrame:
    """Pass attempts with a receiver per game and team."""
    thrown = plays.where(F.col("receiver_player_id").isNotNull())
    return thrown.groupBy("game_id", F.col("posteam").alias("team")).agg(
        sum_or_zero("pass_attempt").alias("team_targets")
    )


def team_passing_totals(player_stats: DataFrame) -> DataFrame:
    """Attempts and yards of all players of a team in a week."""
    return player_stats.groupBy("season", "week", "team").agg(
        sum_or_zero("attempts").alias("team_pass_attempts"),
        sum_or_zero("passing_yards").alias("team_pass_yards"),
    )


def game_opponents(plays: DataFrame) -> DataFrame:
    """Both sides of every game: team and opponent."""
    games = plays.select("game_id", "season", "week", "home_team", "away_team").distinct()
    return two_sided(games, ["game_id", "season", "week"], "home_team", "away_team", "team", "opponent")
