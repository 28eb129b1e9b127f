"""Snap shares per player and week on a gap-filled grid, with week-over-week changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweek.functions.scalars import person_key
from tallyweek.operators.change import change
from tallyweek.operators.counted import Counter, uncounted
from tallyweek.operators.gapfill import gap_fill, period_grid

# People without an id are told apart by name, in matching and in history alike, so no key holds
# more than one person's weeks of a season.
KEYS = ["person", "team", "season"]
LABELS = ["player", "position"]

# What a week without an observation shows.
GAP_VALUES = {
    "opponent": "",
    "offense_snaps": 0.0,
    "offense_pct": 0.0,
    "defense_snaps": 0.0,
    "defense_pct": 0.0,
    "st_snaps": 0.0,
    "st_pct": 0.0,
}

# Share column -> change column.
SHARE_CHANGES = {
    "offense_pct": "wow_offense_snap_share_change",
    "defense_pct": "wow_defense_snap_share_change",
    "st_pct": "wow_special_teams_snap_share_change",
}

# Output columns in order (output name, input name).
REPORT_COLUMNS = [
    ("season", "season"),
    ("week", "week"),
    ("player", "player"),
    ("pfr_player_id", "pfr_player_id"),
    ("position", "position"),
    ("team", "team"),
    ("opponent", "opponent"),
    ("offense_snaps", "offense_snaps"),
    ("offense_snap_share", "offense_pct"),
    ("wow_offense_snap_share_change", "wow_offense_snap_share_change"),
    ("defense_snaps", "defense_snaps"),
    ("defense_snap_share", "defense_pct"),
    ("wow_defense_snap_share_change", "wow_defense_snap_share_change"),
    ("special_teams_snaps", "st_snaps"),
    ("special_teams_snap_share", "st_pct"),
    ("wow_special_teams_snap_share_change", "wow_special_teams_snap_share_change"),
]
SORT_COLUMNS = ["season", "week", "team", "position", "player"]


def _keyed(snaps: DataFrame) -> DataFrame:
    return snaps.withColumn("person", person_key(F.col("player"), ("id", F.col("pfr_player_id"))))


def snap_grid(snaps: DataFrame) -> DataFrame:
    grid = period_grid(_keyed(snaps), KEYS, ["pfr_player_id", *LABELS], "season", "week")
    return grid.select("season", "week", "pfr_player_id", "team", "player", "position")


def snap_share_report(snaps: DataFrame, counted: Counter = uncounted) -> DataFrame:
    filled = gap_fill(_keyed(snaps), KEYS, ["pfr_player_id", *LABELS], "season", "week", GAP_VALUES, counted, LABELS)
    # Two spellings of one id give two rows a week; the labels make their order repeatable.
    changed = change(filled, KEYS, ["week", *LABELS], SHARE_CHANGES)
    # A missing name or position is the first known one of the player's weeks in the team.
    known = {label: F.col(f"known_{label}") for label in LABELS}
    return changed.withColumns(known).select([F.col(source).alias(name) for name, source in REPORT_COLUMNS])


def first_appearances(report: DataFrame) -> DataFrame:
    """Rows without a previous week."""
    return report.where(F.col("wow_offense_snap_share_change").isNull()).select(
        "season", "week", "player", "team", "offense_snap_share", "wow_offense_snap_share_change"
    )


def regular_players(
    report: DataFrame, position: str = "QB", above: float = 0.5, top: int | None = 5, by: tuple = ("season",)
) -> DataFrame:
    """Players of a position by number of weeks above a snap share, the ``top`` of each season.

    Rows collapse to a count per player before the seasons are ranked, and each task keeps only
    its own ``top`` before the shuffle of the ranking window.
    """
    weeks = (
        report.where((F.col("offense_snap_share") > above) & (F.col("position") == position))
        .groupBy(*by, "player", "team")
        .agg(F.count("*").alias("weeks"))
    )
    if top is None:
        return weeks
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("weeks"), "player", "team"))
    return weeks.withColumn("__place", place).where(F.col("__place") <= top).drop("__place")


def top_regular_progression(report: DataFrame, position: str = "QB", above: float = 0.5) -> DataFrame:
    """Week by week rows of each season's most frequent regular of a position."""
    top = regular_players(report, position, above, top=1).select("season", "player", "team")
    return report.join(top, on=["season", "player", "team"], how="left_semi").select(
        "season", "week", "player", "team", "offense_snaps", "offense_snap_share", "wow_offense_snap_share_change"
    )
