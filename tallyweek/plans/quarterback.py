"""Quarterback efficiency per game."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweek.functions.aggregates import avg_where, count_where, sum_or_zero
from tallyweek.functions.scalars import clip, or_zero, person_key, safe_div
from tallyweek.operators.change import change
from tallyweek.operators.counted import Counter, uncounted
from tallyweek.operators.schema import first_available
from tallyweek.plans.team_games import team_game_ids, team_passing_totals

PLAY_METRICS = [
    "epa_per_dropback",
    "success_rate",
    "cpoe",
    "air_yards_per_attempt",
    "big_play_rate",
    "pressure_rate",
]
TEAM_WEEK = ["season", "week", "team"]
BIG_PLAY_YARDS = 20
HISTORY = ["player_key", "season", "team"]
HISTORY_ORDER = ["week", "game_id"]

# Output columns in order.
REPORT_COLUMNS = [
    "season",
    "week",
    "game_id",
    "player",
    "pfr_player_id",
    "team",
    "opponent",
    "position",
    "pass_attempts",
    "completions",
    "completion_pct",
    "passing_yards",
    "passing_tds",
    "interceptions",
    "sacks",
    "sack_yards",
    "yards_per_attempt",
    "net_yards_per_attempt",
    "adjusted_net_yards_per_attempt",
    "passer_rating",
    "dropbacks",
    "yards_per_dropback",
    "total_plays",
    "rush_attempts",
    "rush_yards",
    "rush_tds",
    "total_yards",
    "total_tds",
    "turnovers",
    "td_int_ratio",
    "team_pass_attempt_share",
    "team_pass_yard_share",
    "epa_per_dropback",
    "success_rate",
    "cpoe",
    "air_yards_per_attempt",
    "big_play_rate",
    "pressure_rate",
    "sack_rate",
    "fantasy_points_standard",
    "fantasy_points_ppr",
    "wow_yards_change",
    "wow_td_change",
    "wow_epa_change",
]
SORT_COLUMNS = ["season", "week", "team", "player"]

# Weekly statistic -> report name.
RENAMES = {
    "player_id": "pfr_player_id",
    "passing_interceptions": "interceptions",
    "sacks_suffered": "sacks",
    "sack_yards_lost": "sack_yards",
    "carries": "rush_attempts",
    "rushing_yards": "rush_yards",
    "rushing_tds": "rush_tds",
    "rushing_fumbles_lost": "rush_fumbles_lost",
}


def quarterbacks(player_stats: DataFrame) -> DataFrame:
    """Quarterback weeks with a pass attempt, under the report's names."""
    renamed = player_stats.where((F.col("position") == "QB") & (F.col("attempts") > 0)).withColumnsRenamed(RENAMES)
    return renamed.select(
        "season",
        "week",
        first_available(renamed, ["player_display_name", "player_name"]).alias("player"),
        "pfr_player_id",
        "team",
        first_available(renamed, ["opponent_team", "opponent"], default=F.lit("")).alias("opponent"),
        "position",
        "completions",
        "attempts",
        "passing_yards",
        "passing_tds",
        "interceptions",
        "sacks",
        "sack_yards",
        "rush_attempts",
        "rush_yards",
        "rush_tds",
        "sack_fumbles_lost",
        "rush_fumbles_lost",
    )


def play_metrics(plays: DataFrame) -> DataFrame:
    """Rates per quarterback game over dropbacks (pass attempts and sacks)."""
    attempt = F.col("pass_attempt") == 1
    per_game = (
        plays.where(attempt | (F.col("sack") == 1))
        .groupBy("game_id", "season", "week", F.col("passer_player_id").alias("player_id"), F.col("posteam").alias("team"))
        .agg(
            F.avg("qb_epa").alias("epa_per_dropback"),
            count_where(F.col("qb_epa") > 0).alias("success_plays"),
            F.count("qb_epa").alias("play_dropbacks"),
            F.avg("cpoe").alias("cpoe"),
            avg_where("air_yards", attempt).alias("air_yards_per_attempt"),
            count_where(attempt & (F.col("yards_gained") >= BIG_PLAY_YARDS)).alias("big_plays"),
            sum_or_zero("pass_attempt").alias("play_attempts"),
            count_where(F.col("qb_hit") == 1).alias("pressures"),
        )
    )
    return per_game.withColumns(
        {
            "success_rate": safe_div("success_plays", "play_dropbacks"),
            "big_play_rate": safe_div("big_plays", "play_attempts"),
            "pressure_rate": safe_div("pressures", "play_dropbacks"),
        }
    ).select("game_id", "season", "week", "player_id", "team", *PLAY_METRICS)


def with_efficiency(df: DataFrame) -> DataFrame:
    """Ratios and totals; a NULL in a term that is not defaulted to 0 makes the result NULL."""
    c = F.col
    net_yards = c("passing_yards") - c("sack_yards")
    basic = df.withColumns(
        {
            "completion_pct": safe_div("completions", "attempts"),
            "yards_per_attempt": safe_div("passing_yards", "attempts"),
            "dropbacks": c("attempts") + c("sacks"),
            "turnovers": c("interceptions") + or_zero("sack_fumbles_lost") + or_zero("rush_fumbles_lost"),
            "net_yards_per_attempt": safe_div(net_yards, "attempts"),
            "td_int_ratio": safe_div("passing_tds", "interceptions"),
            "total_yards": c("passing_yards") + or_zero("rush_yards"),
            "total_tds": c("passing_tds") + or_zero("rush_tds"),
        }
    )
    adjusted = c("passing_yards") + 20 * c("passing_tds") - 45 * c("interceptions") - c("sack_yards")
    return basic.withColumns(
        {
            "adjusted_net_yards_per_attempt": safe_div(adjusted, "dropbacks"),
            "yards_per_dropback": safe_div(net_yards, "dropbacks"),
            "sack_rate": safe_div("sacks", "dropbacks"),
            "total_plays": c("dropbacks") + or_zero("rush_attempts"),
        }
    )


def with_team_shares(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "team_pass_attempt_share": safe_div("attempts", "team_pass_attempts"),
            "team_pass_yard_share": safe_div("passing_yards", "team_pass_yards"),
        }
    )


def passer_rating() -> Column:
    """Four components, each clipped to [0, 2.375], on a 0-158.3 scale."""
    attempts = F.col("attempts")

    def component(value: Column, without_attempts: float) -> Column:
        return clip(F.when(attempts > 0, value).otherwise(F.lit(without_attempts)), 0.0, 2.375)

    completion = component((F.col("completions") / attempts - 0.3) * 5, 0.0)
    yards = component((F.col("passing_yards") / attempts - 3) * 0.25, 0.0)
    touchdowns = component(F.col("passing_tds") / attempts * 20, 0.0)
    intercepted = component(2.375 - F.col("interceptions") / attempts * 25, 2.375)
    return (completion + yards + touchdowns + intercepted) / 6 * 100


def with_fantasy(df: DataFrame) -> DataFrame:
    """Standard points; quarterbacks catch no passes, so the reception variant is a copy."""
    standard = (
        F.col("passing_yards") * 0.04
        + F.col("passing_tds") * 4.0
        - F.col("interceptions") * 2.0
        + or_zero("rush_yards") * 0.1
        + or_zero("rush_tds") * 6.0
    )
    return df.withColumn("fantasy_points_standard", standard).withColumn(
        "fantasy_points_ppr", F.col("fantasy_points_standard")
    )


def with_changes(df: DataFrame) -> DataFrame:
    return change(
        df,
        HISTORY,
        HISTORY_ORDER,
        {
            "passing_yards": "wow_yards_change",
            "total_tds": "wow_td_change",
            "epa_per_dropback": "wow_epa_change",
        },
    )


def qb_report(player_stats: DataFrame, plays: DataFrame | None = None, counted: Counter = uncounted) -> DataFrame:
    """Without plays the game id is blank and the play metrics are NULL."""
    rows = counted("quarterback rows", quarterbacks(player_stats)).withColumn(
        "player_key", person_key(F.col("player"), ("id", F.col("pfr_player_id")))
    )
    totals = counted("team passing totals", team_passing_totals(player_stats))
    if plays is None:
        joined = rows.join(totals, on=TEAM_WEEK, how="left").withColumns(
            {"game_id": F.lit(""), **{name: F.lit(None).cast("double") for name in PLAY_METRICS}}
        )
    else:
        # The metrics join and the change window share one shuffle of the rows, and one sort.
        shared = ["player_key", "season"]
        metrics = counted("play metrics", play_metrics(plays)).withColumnRenamed("player_id", "player_key").repartition(*shared)
        joined = (
            rows.join(team_game_ids(plays), on=TEAM_WEEK, how="left")
            .join(totals, on=TEAM_WEEK, how="left")
            .repartition(*shared)
            .join(metrics, on=[*HISTORY, *HISTORY_ORDER], how="left")
        )
    measured = with_team_shares(with_efficiency(joined)).withColumn("passer_rating", passer_rating())
    return with_changes(with_fantasy(measured)).withColumnRenamed("attempts", "pass_attempts").select(*REPORT_COLUMNS)
