"""Input schemas of the landed tables."""

from __future__ import annotations

from pyspark.sql import types as T


TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType()}


def _schema(**names_by_type: list[str]) -> T.StructType:
    return struct_of({name: kind for kind, names in names_by_type.items() for name in names})


def struct_of(columns: dict[str, str]) -> T.StructType:
    """A schema from column name -> type name."""
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in columns.items()])


# The columns of the feeds, by type.
PLAYERS = _schema(
    string=["gsis_id", "pfr_id", "display_name", "position"],
    int=["draft_year", "draft_round", "draft_ovr"],
    double=["height", "weight"],
)
SNAP_COUNTS = _schema(
    string=["game_id", "player", "pfr_player_id", "position", "team", "opponent"],
    int=["season", "week"],
    double=["offense_snaps", "offense_pct", "defense_snaps", "defense_pct", "st_snaps", "st_pct"],
)
PLAYS = _schema(
    string=[
        "game_id",
        "home_team",
        "away_team",
        "posteam",
        "play_type",
        "passer_player_id",
        "receiver_player_id",
        "rusher_player_id",
        "two_point_conv_result",
    ],
    int=["season", "week"],
    double=[
        "pass_attempt",
        "complete_pass",
        "pass_touchdown",
        "interception",
        "first_down_pass",
        "sack",
        "qb_scramble",
        "qb_hit",
        "rush_attempt",
        "rush_touchdown",
        "first_down_rush",
        "yards_gained",
        "rushing_yards",
        "air_yards",
        "yards_after_catch",
        "qb_epa",
        "cpoe",
    ],
)
PLAYER_STATS = _schema(
    string=["player_id", "player_display_name", "position", "team", "opponent_team"],
    int=["season", "week"],
    double=[
        "completions",
        "attempts",
        "passing_yards",
        "passing_tds",
        "passing_interceptions",
        "sacks_suffered",
        "sack_yards_lost",
        "carries",
        "rushing_yards",
        "rushing_tds",
        "rushing_fumbles_lost",
        "sack_fumbles_lost",
        "receptions",
        "targets",
    ],
)
TEAM_STATS = _schema(
    string=["team"],
    int=["season", "week"],
    double=["attempts"],
)
TRACKING_PASSING = _schema(
    string=["player_gsis_id"],
    int=["season", "week"],
    double=[
        "avg_time_to_throw",
        "avg_completed_air_yards",
        "avg_intended_air_yards",
        "avg_air_yards_differential",
        "aggressiveness",
        "max_completed_air_distance",
        "avg_air_yards_to_sticks",
        "completion_percentage",
        "expected_completion_percentage",
        "completion_percentage_above_expectation",
    ],
)
TRACKING_RECEIVING = _schema(
    string=["player_gsis_id"],
    int=["season", "week"],
    double=[
        "avg_cushion",
        "avg_separation",
        "avg_intended_air_yards",
        "percent_share_of_intended_air_yards",
        "catch_percentage",
        "avg_yac",
        "avg_expected_yac",
        "avg_yac_above_expectation",
    ],
)
TRACKING_RUSHING = _schema(
    string=["player_gsis_id"],
    int=["season", "week"],
    double=[
        "efficiency",
        "percent_attempts_gte_eight_defenders",
        "avg_time_to_los",
        "expected_rush_yards",
        "rush_yards_over_expected",
        "avg_rush_yards",
        "rush_yards_over_expected_per_att",
        "rush_pct_over_expected",
    ],
)
COMBINE = _schema(
    string=["pfr_id"],
    double=["forty", "bench", "vertical", "broad_jump", "cone", "shuttle"],
)

LANDED = {
    "players": PLAYERS,
    "snap_counts": SNAP_COUNTS,
    "plays": PLAYS,
    "player_stats": PLAYER_STATS,
    "team_stats": TEAM_STATS,
    "tracking_passing": TRACKING_PASSING,
    "tracking_receiving": TRACKING_RECEIVING,
    "tracking_rushing": TRACKING_RUSHING,
    "combine": COMBINE,
}
