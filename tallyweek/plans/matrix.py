"""Player-by-week matrices of the weekly report: rows, cells, intensities, labels, boundaries.

There is one matrix per season, so the season leads every key. ``Matrix`` holds what the results
share, each landed once: the regulars' rows, with the weeks they played, which are taken while
writing; the order of the matrix rows; and the expanded cells. The functions below it only plan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweek.functions.scalars import clip, one_decimal_text, percent_text, position_order, whole_text
from tallyweek.operators.entities import min_appearances
from tallyweek.operators.lookup import scalar_map
from tallyweek.operators.ranking import null_safe_join, places_in_order
from tallyweek.operators.reshape import first_cells, pivot_period
from tallyweek.sinks.landing import land, land_observed

SKILL_POSITIONS = ["QB", "WR", "RB", "TE"]
INPUT_COLUMNS = [
    "season",
    "week",
    "team",
    "position",
    "player_name",
    "offense_snap_share",
    "targets",
    "percent_share_of_intended_air_yards",
    "avg_yac",
    "rush_first_downs",
    "receiving_first_downs",
    "completion_percentage",
]
SNAP_SHARE = "offense_snap_share"

# The positions for which a measure has cells.
MEASURE_POSITIONS = {
    "offense_snap_share": ["QB", "WR", "RB", "TE"],
    "targets": ["WR", "RB", "TE"],
    "percent_share_of_intended_air_yards": ["WR", "RB", "TE"],
    "avg_yac": ["WR", "TE"],
    "rush_first_downs": ["RB"],
    "receiving_first_downs": ["WR", "RB", "TE"],
    "completion_percentage": ["QB"],
}
# The metric rows under a player's row, by position, in order.
METRIC_ROWS = {
    "QB": ["completion_percentage"],
    "RB": ["targets", "rush_first_downs", "receiving_first_downs"],
    "WR": ["targets", "avg_yac", "receiving_first_downs"],
    "TE": ["targets", "avg_yac", "receiving_first_downs"],
}
# Row label and row key suffix of a metric.
METRIC_LABELS = {
    "completion_percentage": ("  → Comp %", "_comp_pct"),
    "targets": ("  → Targets", "_targets"),
    "rush_first_downs": ("  → Rush 1st D", "_rush_fd"),
    "avg_yac": ("  → Avg YAC", "_avg_yac"),
    "receiving_first_downs": ("  → Rec 1st D", "_rec_fd"),
}
# The scale's top where a metric has no positive maximum.
DEFAULT_MAXIMUM = {"targets": 15.0, "avg_yac": 10.0, "rush_first_downs": 5.0, "receiving_first_downs": 5.0}
# A cell is highlighted above these.
HIGH_ABOVE = {
    "targets": 5.0,
    "avg_yac": 5.0,
    "rush_first_downs": 2.0,
    "receiving_first_downs": 2.0,
    "completion_percentage": 65.0,
}


def skilled_rows(report: DataFrame) -> DataFrame:
    """Skill-position rows with a snap share."""
    rows = report.where(F.col("position").isin(SKILL_POSITIONS) & F.col(SNAP_SHARE).isNotNull())
    return rows.select(*INPUT_COLUMNS)


def regulars_of(rows: DataFrame, min_games: int = 3) -> DataFrame:
    """Rows of names that appear at least ``min_games`` times in a season."""
    return min_appearances(rows, ["season", "player_name"], "week", min_games)


def skill_regulars(report: DataFrame, min_games: int = 3) -> DataFrame:
    """Skill-position rows with a snap share, of names that appear at least ``min_games`` times."""
    return regulars_of(skilled_rows(report), min_games)


def _metric_rows_of() -> Column:
    """How many metric rows follow a player's row."""
    count = F.lit(0)
    for position, metrics in METRIC_ROWS.items():
        count = F.when(F.col("position") == position, F.lit(len(metrics))).otherwise(count)
    return count


def player_order(regulars: DataFrame) -> DataFrame:
    """Matrix rows: one per name, ordered by team, position and mean share; landed when called.

    A name's team and position are those of its first row by week, team and position.
    ``row_index`` counts player rows, ``expanded_index`` also the metric rows between them.
    """
    first = F.min_by(
        F.struct(position_order(F.col("position")).alias("pos_order"), "team", "position"),
        F.struct("week", "team", "position"),
    )
    # A sum of decimals is the same in any order, so the order by the mean is repeatable.
    mean = F.sum(F.col(SNAP_SHARE).cast("decimal(18,12)")).cast("double") / F.count(SNAP_SHARE)
    players = (
        regulars.groupBy("season", "player_name")
        .agg(mean.alias("avg_snap"), first.alias("first"))
        .select("season", "player_name", "avg_snap", "first.*")
    )
    order = [F.asc_nulls_first("team"), F.asc_nulls_first("pos_order"), F.desc("avg_snap"), F.asc("player_name")]
    sizes = {"row_index": F.lit(1), "expanded_index": 1 + _metric_rows_of()}
    return places_in_order(players, ["season"], order, sizes, "player_order").select(
        "season",
        F.col("player_name").alias("composite_label"),
        "player_name",
        "team",
        "position",
        "pos_order",
        "avg_snap",
        "row_index",
        "expanded_index",
    )


def matrix_cells(regulars: DataFrame, order: DataFrame) -> DataFrame:
    """First row's measures per season, name and week, kept only for the name's position."""
    measures = list(MEASURE_POSITIONS)
    # All measures take part in the order, so equal leading values leave no choice.
    cells = first_cells(regulars, ["season", "player_name", "week"], ["team", "position", *measures], measures)
    joined = cells.join(order, on=["season", "player_name"], how="inner")

    def kept(measure: str) -> Column:
        value = F.col(measure)
        return F.when(F.col("position").isin(MEASURE_POSITIONS[measure]) & ~F.isnan(value), value)

    return joined.withColumns({m: kept(m) for m in measures})


def snap_matrix(regulars: DataFrame, order: DataFrame, weeks: Sequence[int]) -> DataFrame:
    """The measures' matrices stacked: a row per measure and name, a column per week."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURE_POSITIONS])
    )
    cells = matrix_cells(regulars, order).select(
        "season", "row_index", "player_name", "team", "position", "week", pairs.alias("cell")
    )
    long = cells.select("season", "row_index", "player_name", "team", "position", "week", "cell.*")
    rows = ["season", "measure", "row_index", "player_name", "team", "position"]
    return pivot_period(long, rows, "week", weeks, "value")


def metric_rows(regulars: DataFrame, order: DataFrame) -> DataFrame:
    """The expanded matrix, long: a snap-share row per name followed by its position's metrics."""

    def entry(place: int, metric: str, label: Column, key: Column, share: Column) -> Column:
        return F.struct(
            F.lit(place).alias("place"),
            F.lit(metric).alias("metric"),
            label.alias("row_label"),
            key.alias("row_key"),
            F.col(metric).alias("value"),
            share.alias("target_share"),
        )

    name = F.col("player_name")
    none = F.lit(None).cast("double")

    def entries(metrics: list[str]) -> Column:
        rows = [entry(0, SNAP_SHARE, name, name, none)]
        for place, metric in enumerate(metrics, start=1):
            label, suffix = METRIC_LABELS[metric]
            share = F.col("percent_share_of_intended_air_yards") if metric == "targets" else none
            rows.append(entry(place, metric, F.lit(label), F.concat(name, F.lit(suffix)), share))
        return F.array(*rows)

    expanded = entries([])
    for position, metrics in METRIC_ROWS.items():
        expanded = F.when(F.col("position") == position, entries(metrics)).otherwise(expanded)
    cells = matrix_cells(regulars, order).withColumn("row", F.explode(expanded))
    return cells.select(
        "season",
        (F.col("expanded_index") + F.col("row.place")).alias("row_index"),
        "player_name",
        "team",
        "position",
        "row.metric",
        "row.row_label",
        "row.row_key",
        "week",
        F.concat(F.lit("Week "), F.col("week")).alias("week_label"),
        "row.value",
        "row.target_share",
    )


def cell_intensity(rows: DataFrame) -> DataFrame:
    """Colour intensity per cell: share of the season's maximum, or the metric's fixed range.

    ``rows`` are metric rows, which hold every cell of the scaled metrics once; they are read twice,
    so they should come from a landed table."""
    scale_key = F.concat_ws("|", "season", "metric")
    maxima = (
        rows.where(F.col("season").isNotNull() & F.col("metric").isin(list(DEFAULT_MAXIMUM)))
        .groupBy(scale_key.alias("scale_key"))
        .agg(F.max("value").alias("maximum"))
    )
    maximum = F.nullif(F.try_element_at(scalar_map(maxima, "scale_key", "maximum"), scale_key), F.lit(0.0))
    default = F.lit(None).cast("double")
    for metric, value in DEFAULT_MAXIMUM.items():
        default = F.when(F.col("metric") == metric, F.lit(value)).otherwise(default)
    with_top = rows.withColumn("scale_maximum", F.coalesce(maximum, default))
    value = F.col("value")
    intensity = (
        F.when(
            F.col("metric").isin(list(DEFAULT_MAXIMUM)),
            F.when(value.isNotNull(), F.least(value / F.col("scale_maximum"), F.lit(1.0))),
        )
        .when(F.col("metric") == "completion_percentage", clip((value - 40) / 60, 0.0, 1.0))
        .otherwise(value)
    )
    return with_top.withColumn("intensity", intensity).select(
        "season", "row_index", "player_name", "metric", "week", "value", "scale_maximum", "intensity"
    )


class Matrix:
    """The parts of a season's heat map over the weekly rows of a report.

    Each part is landed when it is first asked for, and read by all results that need it."""

    def __init__(self, report: DataFrame, min_games: int = 3, reread: bool = True):
        """``reread``: whether the report is cheap to read twice, as written files are."""
        rows = skilled_rows(report)
        self._rows, self._least = rows if reread else land(rows, "weekly_rows"), min_games

    @cached_property
    def _landed(self) -> tuple[DataFrame, dict]:
        return land_observed(regulars_of(self._rows, self._least), "regulars", weeks=F.collect_set("week"))

    @property
    def regulars(self) -> DataFrame:
        return self._landed[0]

    @property
    def weeks(self) -> list[int]:
        return sorted(self._landed[1]["weeks"])

    @cached_property
    def order(self) -> DataFrame:
        return player_order(self.regulars)

    @cached_property
    def rows(self) -> DataFrame:
        return land(metric_rows(self.regulars, self.order), "metric_rows")

    def snap_matrix(self) -> DataFrame:
        return snap_matrix(self.regulars, self.order, self.weeks)

    def cell_intensity(self) -> DataFrame:
        return cell_intensity(self.rows)

    def cell_labels(self, threshold: float = 0.5) -> DataFrame:
        return cell_labels(self.rows, threshold)

    def group_boundaries(self) -> DataFrame:
        return group_boundaries(self.order)


def cell_labels(rows: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Text and highlight flag of every cell that has a value."""
    metric, value = F.col("metric"), F.col("value")
    text = (
        F.when(metric.isin("targets", "rush_first_downs", "receiving_first_downs"), whole_text(value))
        .when(metric == "avg_yac", one_decimal_text(value))
        .when(metric == "completion_percentage", percent_text(value))
        .otherwise(percent_text(value * 100))
    )
    above = F.lit(threshold)
    for name, limit in HIGH_ABOVE.items():
        above = F.when(metric == name, F.lit(limit)).otherwise(above)
    return rows.where(value.isNotNull()).select(
        "season", "row_index", "player_name", "metric", "week", "value", text.alias("text"), (value > above).alias("high")
    )


def group_boundaries(order: DataFrame) -> DataFrame:
    """Separator lines between the expanded rows.

    ``team`` lines carry the label of the team that ends there, ``position`` lines separate
    positions within a team, and ``end`` closes a season's last team.
    """
    spans = (
        order.withColumn("last_index", F.col("expanded_index") + _metric_rows_of())
        .groupBy("season", "team", "pos_order")
        .agg(F.max("last_index").alias("last_index"))
    )
    teams = spans.groupBy("season", "team").agg(F.max("last_index").alias("team_end"))
    season_end = scalar_map(
        teams.groupBy("season").agg(F.max("team_end").alias("season_end")).where(F.col("season").isNotNull()),
        "season",
        "season_end",
    )
    ends = null_safe_join(spans, teams, ["season", "team"], "inner")
    line = F.col("last_index") + 0.5
    kind = (
        F.when(F.col("last_index") == F.try_element_at(season_end, F.col("season")), "end")
        .when(F.col("last_index") == F.col("team_end"), "team")
        .otherwise("position")
    )
    return ends.select("season", line.alias("line_at"), kind.alias("kind"), "team").select(
        "season",
        "line_at",
        "kind",
        F.when(F.col("kind") != "position", F.col("team")).alias("team_label"),
    )
