"""The wide opportunity report: snaps, profile, play statistics, tracking, combine, fantasy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweek.functions.aggregates import count_where, sum_where
from tallyweek.functions.scalars import fallback_blank, or_zero, person_key, safe_div
from tallyweek.operators.change import change
from tallyweek.operators.counted import Counter, uncounted
from tallyweek.operators.entities import bridge_id
from tallyweek.operators.ranking import with_dense_rank
from tallyweek.operators.schema import select_available
from tallyweek.operators.scoring import weighted_score
from tallyweek.plans.snap_share import SHARE_CHANGES
from tallyweek.plans.team_games import game_opponents
from tallyweek.sinks.landing import land
from tallyweek.sources.schemas import struct_of
from tallyweek.sources.scoring import column_weights

# Source column -> report column.
PROFILE_COLUMNS = [
    "gsis_id",
    "pfr_id",
    "display_name",
    "position",
    "draft_year",
    "draft_round",
    "draft_ovr",
    "height",
    "weight",
]
PROFILE_RENAMES = {
    "display_name": "player_name",
    "draft_ovr": "draft_pick",
    "height": "player_height",
    "weight": "player_weight",
}
COMBINE_COLUMNS = ["pfr_id", "forty", "bench", "vertical", "broad_jump", "cone", "shuttle"]
COMBINE_RENAMES = {"forty": "fourty"}
TRACKING_PASSING_COLUMNS = [
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
]
TRACKING_RECEIVING_COLUMNS = [
    "avg_cushion",
    "avg_separation",
    "avg_intended_air_yards",
    "percent_share_of_intended_air_yards",
    "catch_percentage",
    "avg_yac",
    "avg_expected_yac",
    "avg_yac_above_expectation",
]
TRACKING_RECEIVING_RENAMES = {"avg_intended_air_yards": "avg_air_distance"}
TRACKING_RUSHING_COLUMNS = [
    "efficiency",
    "percent_attempts_gte_eight_defenders",
    "avg_time_to_los",
    "expected_rush_yards",
    "rush_yards_over_expected",
    "avg_rush_yards",
    "rush_yards_over_expected_per_att",
    "rush_pct_over_expected",
]

# The report's columns and types in order.
_REPORT = {
    "season": "int",
    "week": "int",
    "player_name": "string",
    "gsis_id": "string",
    "position": "string",
    "team": "string",
    "opponent": "string",
    "draft_year": "int",
    "draft_round": "int",
    "draft_pick": "int",
    "player_height": "double",
    "player_weight": "double",
    "fourty": "double",
    "bench": "double",
    "vertical": "double",
    "broad_jump": "double",
    "cone": "double",
    "shuttle": "double",
    "offense_snaps": "double",
    "offense_snap_share": "double",
    "wow_offense_snap_share_change": "double",
    "defense_snaps": "double",
    "defense_snap_share": "double",
    "wow_defense_snap_share_change": "double",
    "special_teams_snaps": "double",
    "special_teams_snap_share": "double",
    "wow_special_teams_snap_share_change": "double",
    "pass_attempts": "double",
    "pass_complete": "double",
    "pass_touchdowns": "double",
    "passing_yards": "double",
    "interceptions": "double",
    "pass_first_downs": "double",
    "pass_2pt_conversions": "bigint",
    "avg_time_to_throw": "double",
    "avg_completed_air_yards": "double",
    "avg_intended_air_yards": "double",
    "avg_air_yards_differential": "double",
    "aggressiveness": "double",
    "max_completed_air_distance": "double",
    "avg_air_yards_to_sticks": "double",
    "completion_percentage": "double",
    "expected_completion_percentage": "double",
    "completion_percentage_above_expectation": "double",
    "receptions": "double",
    "receiving_yards": "double",
    "receiving_air_yards": "double",
    "receiving_yac": "double",
    "receiving_touchdowns": "double",
    "receiving_first_downs": "double",
    "receiving_2pt_conversions": "bigint",
    "avg_air_distance": "double",
    "max_air_distance": "double",
    "avg_cushion": "double",
    "avg_separation": "double",
    "percent_share_of_intended_air_yards": "double",
    "targets": "double",
    "target_share": "double",
    "catch_percentage": "double",
    "avg_yac": "double",
    "avg_expected_yac": "double",
    "avg_yac_above_expectation": "double",
    "rush_attempts": "double",
    "rushing_yards": "double",
    "rush_touchdowns": "double",
    "rush_first_downs": "double",
    "efficiency": "double",
    "percent_attempts_gte_eight_defenders": "double",
    "avg_time_to_los": "double",
    "expected_rush_yards": "double",
    "rush_yards_over_expected": "double",
    "avg_rush_yards": "double",
    "rush_yards_over_expected_per_att": "double",
    "rush_pct_over_expected": "double",
    "fantasy_points": "double",
    "f_position_rank": "int",
}
REPORT_SCHEMA = struct_of(_REPORT)
REPORT_COLUMNS = list(_REPORT)
SORT_COLUMNS = ["season", "week", "team", "position", "player_name"]

HISTORY = ["player_key", "season", "team"]
HISTORY_ORDER = ["week", "game_id"]
PLAYER_GAME = ["game_id", "season", "week", "gsis_id", "team"]
PLAY_COLUMNS = [
    "game_id",
    "season",
    "week",
    "posteam",
    "pass_attempt",
    "complete_pass",
    "pass_touchdown",
    "interception",
    "first_down_pass",
    "rush_attempt",
    "rush_touchdown",
    "first_down_rush",
    "yards_gained",
    "air_yards",
    "yards_after_catch",
    "two_point_conv_result",
]


def player_profile(players: DataFrame) -> DataFrame:
    return select_available(players, PROFILE_COLUMNS).withColumnsRenamed(PROFILE_RENAMES)


def with_player_ids(snaps: DataFrame, players: DataFrame) -> DataFrame:
    """Snap rows with the player's ``gsis_id`` and a ``player_key`` that is never blank.

    Rows without a mapped id are keyed by their own id or name, so they neither mix different
    people in one change history nor pile up in one partition of the joins that follow.
    """
    mapped = bridge_id(snaps, players.select("gsis_id", "pfr_id"), "pfr_player_id", "pfr_id", apart=["game_id", "player"])
    key = person_key(F.col("player"), ("gsis", F.col("gsis_id")), ("pfr", F.col("pfr_player_id")))
    return mapped.withColumn("player_key", key)


def snap_changes(snaps_with_ids: DataFrame) -> DataFrame:
    changed = change(snaps_with_ids, HISTORY, HISTORY_ORDER, SHARE_CHANGES)
    return changed.withColumnsRenamed(
        {
            "offense_pct": "offense_snap_share",
            "defense_pct": "defense_snap_share",
            "st_snaps": "special_teams_snaps",
            "st_pct": "special_teams_snap_share",
        }
    ).select(
        "player_key",
        "gsis_id",
        "season",
        "week",
        "team",
        "opponent",
        "game_id",
        "offense_snaps",
        "offense_snap_share",
        "wow_offense_snap_share_change",
        "defense_snaps",
        "defense_snap_share",
        "wow_defense_snap_share_change",
        "special_teams_snaps",
        "special_teams_snap_share",
        "wow_special_teams_snap_share_change",
    )


def snap_with_ids(snaps: DataFrame, players: DataFrame) -> DataFrame:
    return snap_changes(with_player_ids(snaps, players)).drop("player_key")


def passing_aggregates(rows: Column | None = None) -> dict[str, Column]:
    """Passing statistics over the passer's plays; ``rows`` restricts them further."""
    on = F.lit(True) if rows is None else rows
    attempt = F.col("pass_attempt") == 1
    return {
        "pass_attempts": sum_where("pass_attempt", on),
        "pass_complete": sum_where("complete_pass", on),
        "passing_yards": sum_where("yards_gained", on & attempt),
        "pass_touchdowns": sum_where("pass_touchdown", on),
        "interceptions": sum_where("interception", on),
        "pass_first_downs": sum_where("first_down_pass", on),
        "pass_2pt_conversions": count_where(on & attempt & (F.col("two_point_conv_result") == "success")),
    }


def receiving_aggregates(rows: Column | None = None) -> dict[str, Column]:
    on = F.lit(True) if rows is None else rows
    complete = F.col("complete_pass") == 1
    return {
        "receptions": sum_where("complete_pass", on),
        "targets": sum_where("pass_attempt", on),
        "receiving_yards": sum_where("yards_gained", on & complete),
        "receiving_air_yards": sum_where("air_yards", on & (F.col("pass_attempt") == 1)),
        "receiving_yac": sum_where("yards_after_catch", on & complete),
        "receiving_touchdowns": sum_where("pass_touchdown", on),
        "receiving_first_downs": sum_where("first_down_pass", on & complete),
        "receiving_2pt_conversions": count_where(on & complete & (F.col("two_point_conv_result") == "success")),
    }


def rushing_aggregates(rows: Column | None = None) -> dict[str, Column]:
    on = F.lit(True) if rows is None else rows
    return {
        "rush_attempts": sum_where("rush_attempt", on),
        "rushing_yards": sum_where("yards_gained", on & (F.col("rush_attempt") == 1)),
        "rush_touchdowns": sum_where("rush_touchdown", on),
        "rush_first_downs": sum_where("first_down_rush", on),
    }


def role_by_game(plays: DataFrame, player_id: str, aggregates: Mapping[str, Column]) -> DataFrame:
    """One role's statistics per player and game."""
    keys = ["game_id", "season", "week", F.col(player_id).alias("gsis_id"), F.col("posteam").alias("team")]
    grouped = plays.where(F.col(player_id).isNotNull()).groupBy(*keys)
    return grouped.agg(*[c.alias(name) for name, c in aggregates.items()])


def passing_by_game(plays: DataFrame) -> DataFrame:
    return role_by_game(plays, "passer_player_id", passing_aggregates())


def receiving_by_game(plays: DataFrame) -> DataFrame:
    return role_by_game(plays, "receiver_player_id", receiving_aggregates())


def rushing_by_game(plays: DataFrame) -> DataFrame:
    return role_by_game(plays, "rusher_player_id", rushing_aggregates())


def player_game_stats(plays: DataFrame) -> DataFrame:
    """Passing, receiving and rushing of a player in a game, with the share of team targets.

    One scan and one shuffle: every play yields a row per filled role, and one aggregation on the
    player-game keys takes the place of a full outer join of three role tables. Statistics of a
    role the player did not have stay NULL. A NULL key never matches in such a join, so those
    rows stay apart by role.
    """
    roles = [
        ("passer_player_id", passing_aggregates),
        ("receiver_player_id", receiving_aggregates),
        ("rusher_player_id", rushing_aggregates),
    ]
    filled = F.stack(F.lit(len(roles)), *[c for i, (pid, _) in enumerate(roles) for c in (F.lit(i), F.col(pid))])
    acting = plays.select(*PLAY_COLUMNS, filled.alias("role", "actor")).where(F.col("actor").isNotNull())
    unmatched = reduce(
        lambda a, b: a | b, [F.col(k).isNull() for k in ("game_id", "season", "week", "posteam")]
    )
    aggregates: list[Column] = []
    for role, (_, stats) in enumerate(roles):
        on = F.col("role") == role
        present = F.count(F.when(on, F.lit(1))) > 0
        aggregates += [F.when(present, c).alias(name) for name, c in stats(on).items()]
    per_player = acting.groupBy(
        "game_id",
        "season",
        "week",
        F.col("actor").alias("gsis_id"),
        F.col("posteam").alias("team"),
        F.when(unmatched, F.col("role")).alias("__apart"),
    ).agg(*aggregates)
    # At most a roster per group: the plays are already summed up per player, and rows without a
    # game or team, which have no team total, are spread by player.
    known = F.col("game_id").isNotNull() & F.col("team").isNotNull()
    team_game = Window.partitionBy("game_id", "team", F.when(~known, F.col("gsis_id")))
    return (
        per_player.drop("__apart")
        .withColumn("team_targets", F.when(known, F.sum("targets").over(team_game)))
        .withColumn("target_share", safe_div("targets", "team_targets"))
    )


def fill_opponents(snaps: DataFrame, opponents: DataFrame) -> DataFrame:
    """Blank or missing opponents taken from the game's two sides."""
    sides = opponents.select("game_id", "team", F.col("opponent").alias("mapped_opponent"))
    joined = snaps.join(sides, on=["game_id", "team"], how="left")
    return joined.withColumn("opponent", fallback_blank(F.col("opponent"), F.col("mapped_opponent"))).drop(
        "mapped_opponent"
    )


def tracking(df: DataFrame, columns: list[str], renames: Mapping[str, str] | None = None) -> DataFrame:
    wanted = select_available(df, ["player_gsis_id", "season", "week", *columns])
    return wanted.withColumnsRenamed({"player_gsis_id": "gsis_id", **(renames or {})})


def tracking_tables(passing: DataFrame, receiving: DataFrame, rushing: DataFrame) -> list[DataFrame]:
    return [
        tracking(passing, TRACKING_PASSING_COLUMNS),
        tracking(receiving, TRACKING_RECEIVING_COLUMNS, TRACKING_RECEIVING_RENAMES),
        tracking(rushing, TRACKING_RUSHING_COLUMNS),
    ]


def join_tracking(df: DataFrame, tables: list[DataFrame], key: str = "gsis_id") -> DataFrame:
    for table in tables:
        df = df.join(table.withColumnRenamed("gsis_id", key), on=[key, "season", "week"], how="left")
    return df


def combine_by_player(combine: DataFrame, players: DataFrame) -> DataFrame:
    measured = select_available(combine, COMBINE_COLUMNS).withColumnsRenamed(COMBINE_RENAMES)
    ids = players.select("gsis_id", "pfr_id")
    joined = bridge_id(measured, ids, "pfr_id", "pfr_id", how="inner")
    return joined.select("gsis_id", *[c for c in measured.columns if c != "pfr_id"])


def fantasy_points(df: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    return df.withColumn("fantasy_points", weighted_score(weights or column_weights()))


def position_rank(df: DataFrame) -> DataFrame:
    """Dense rank of the points within season, week and position, best first.

    Players without an offensive snap take part in the ranking but show no rank. The rows should
    come from a landed table: see ``with_dense_rank``.
    """
    return with_dense_rank(
        df,
        ["season", "week", "position"],
        "fantasy_points",
        "f_position_rank",
        shown=or_zero("offense_snaps") >= 1,
    )


def scored_rows(
    snaps: DataFrame,
    players: DataFrame,
    plays: DataFrame,
    weights: Mapping[str, float] | None = None,
    opponents: bool = True,
    counted: Counter = uncounted,
) -> DataFrame:
    """Snap rows with changes, play statistics, position and points, landed in the shared folder.

    The play statistics are aggregated once for ranking and report, and both read the same bits.
    From the repartition on, the change window and the statistics join work on (player_key,
    season); a player's weeks of a season are all that shares a key.
    """
    base = counted("snap rows with ids", with_player_ids(snaps, players))
    if opponents:
        base = fill_opponents(base, counted("sides of games", game_opponents(plays)))
    stats = counted("player games", player_game_stats(plays)).withColumnRenamed("gsis_id", "player_key")
    scored = scored_from_facts(base.repartition("player_key", "season"), stats, players, weights)
    return land(counted("scored rows", scored), "scored_rows")


def scored_from_facts(
    snaps: DataFrame, stats: DataFrame, players: DataFrame, weights: Mapping[str, float] | None = None
) -> DataFrame:
    """Changes, statistics, position and points of keyed snap rows. Facts that lie in buckets by
    player and season stay where they are."""
    joined = snap_changes(snaps).join(stats, on=[*HISTORY, *HISTORY_ORDER], how="left")
    positions = players.select(F.col("gsis_id").alias("player_key"), "position")
    return fantasy_points(joined.join(positions, on="player_key", how="left"), weights)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in order; columns the inputs could not supply are NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def with_dimensions(
    rows: DataFrame,
    players: DataFrame,
    tracking_passing: DataFrame,
    tracking_receiving: DataFrame,
    tracking_rushing: DataFrame,
    combine: DataFrame,
    counted: Counter = uncounted,
) -> DataFrame:
    """The scored rows with tracking measures, profile and combine results."""
    tables = tracking_tables(tracking_passing, tracking_receiving, tracking_rushing)
    names = ("passing", "receiving", "rushing")
    tables = [counted(f"tracking rows, {name}", table) for name, table in zip(names, tables, strict=True)]
    return join_dimensions(join_tracking(rows, tables, "player_key"), players, combine, counted)


def join_dimensions(
    rows: DataFrame, players: DataFrame, combine: DataFrame, counted: Counter = uncounted
) -> DataFrame:
    """Profile and combine results. They meet as dimensions, so the wide rows join once."""
    profile = counted("player profiles", player_profile(players)).drop("pfr_id", "position")
    measured = counted("combine rows of players", combine_by_player(combine, players))
    profile = profile.join(measured, on="gsis_id", how="left")
    return rows.join(profile.withColumnRenamed("gsis_id", "player_key"), on="player_key", how="left")


def report_from_facts(
    snaps: DataFrame,
    stats: DataFrame,
    tracking_keyed: Sequence[DataFrame],
    players: DataFrame,
    combine: DataFrame,
    weights: Mapping[str, float] | None = None,
) -> DataFrame:
    """The report from landed facts: keyed snap rows with opponents, statistics per player and game,
    and the three tracking tables under the player's key. Its scored rows, which hold all measures
    by then, are landed while it is built; only the rank moves rows."""
    scored = join_tracking(scored_from_facts(snaps, stats, players, weights), list(tracking_keyed), "player_key")
    ranked = position_rank(land(scored, "scored_rows"))
    return conform(join_dimensions(ranked, players, combine), REPORT_SCHEMA)


def matrix_input(
    snaps: DataFrame, players: DataFrame, plays: DataFrame, tracking_passing: DataFrame, tracking_receiving: DataFrame
) -> DataFrame:
    """The weekly report's rows with the few columns the matrices need, and nothing else derived:
    no opponents, changes, points, ranks or combine results."""
    keys = [*HISTORY, *HISTORY_ORDER]
    base = with_player_ids(snaps, players).select(*keys, F.col("offense_pct").alias("offense_snap_share"))
    stats = player_game_stats(plays).withColumnRenamed("gsis_id", "player_key")
    stats = stats.select(*keys, "targets", "rush_first_downs", "receiving_first_downs")
    names = player_profile(players).select(F.col("gsis_id").alias("player_key"), "player_name", "position")
    rows = base.repartition("player_key", "season").join(stats, on=keys, how="left").join(names, on="player_key", how="left")
    passing, receiving, _ = tracking_tables(tracking_passing, tracking_receiving, tracking_receiving)
    measures = [
        passing.select("gsis_id", "season", "week", "completion_percentage"),
        receiving.select("gsis_id", "season", "week", "percent_share_of_intended_air_yards", "avg_yac"),
    ]
    return join_tracking(rows, measures, "player_key")


def opportunity_report(
    snaps: DataFrame,
    players: DataFrame,
    plays: DataFrame,
    tracking_passing: DataFrame,
    tracking_receiving: DataFrame,
    tracking_rushing: DataFrame,
    combine: DataFrame,
    weights: Mapping[str, float] | None = None,
    counted: Counter = uncounted,
) -> DataFrame:
    """The report. Building it runs a job: the scored rows are landed; the rank joins them while narrow."""
    ranked = position_rank(scored_rows(snaps, players, plays, weights, counted=counted))
    tracked = (tracking_passing, tracking_receiving, tracking_rushing)
    rows = with_dimensions(ranked, players, *tracked, combine, counted)
    return conform(rows, REPORT_SCHEMA)
