"""Receiving opportunity: targets against team passing volume."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweek.functions.scalars import person_key, safe_div
from tallyweek.operators.change import change
from tallyweek.operators.counted import Counter, uncounted
from tallyweek.operators.schema import first_available
from tallyweek.plans.team_games import team_games_with_dropbacks

# Output columns in order.
REPORT_COLUMNS = [
    "season",
    "week",
    "game_id",
    "player",
    "pfr_player_id",
    "position",
    "team",
    "opponent",
    "receptions",
    "targets",
    "team_pass_attempts",
    "team_dropbacks",
    "target_share",
    "targets_per_dropback",
    "wow_target_share_change",
]
SORT_COLUMNS = ["season", "week", "team", "position", "player"]
TEAM_WEEK = ["season", "week", "team"]


def receivers(player_stats: DataFrame) -> DataFrame:
    """Rows with targets, under the report's names. ``pfr_player_id`` carries the general id."""
    return player_stats.where(F.col("targets") > 0).select(
        "season",
        "week",
        first_available(player_stats, ["player_display_name", "player_name"]).alias("player"),
        F.col("player_id").alias("pfr_player_id"),
        "position",
        "team",
        first_available(player_stats, ["opponent_team", "opponent"], default=F.lit("")).alias("opponent"),
        "receptions",
        "targets",
    )


def receiving_report(
    player_stats: DataFrame, team_stats: DataFrame, plays: DataFrame, counted: Counter = uncounted
) -> DataFrame:
    team_attempts = team_stats.select(*TEAM_WEEK, F.col("attempts").alias("team_pass_attempts"))
    joined = (
        counted("rows with targets", receivers(player_stats))
        .join(team_games_with_dropbacks(plays), on=TEAM_WEEK, how="left")
        .join(team_attempts, on=TEAM_WEEK, how="left")
        .withColumns(
            {
                "target_share": safe_div("targets", "team_pass_attempts"),
                "targets_per_dropback": safe_div("targets", "team_dropbacks"),
                "player_key": person_key(F.col("player"), ("id", F.col("pfr_player_id"))),
            }
        )
    )
    changed = change(
        joined, ["player_key", "team", "season"], ["week", "game_id"], {"target_share": "wow_target_share_change"}
    )
    return changed.select(*REPORT_COLUMNS)
