"""Reports from landed tables: read the inputs, build the plan, write season files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyweek.checks import REPORT_KEY, assert_unique
from tallyweek.operators.counted import Counter, StageCounts, uncounted
from tallyweek.operators.schema import optional
from tallyweek.plans import matrix, opportunity, quarterback, receiving, snap_share
from tallyweek.sinks.facts import Facts
from tallyweek.sinks.publish import publish
from tallyweek.sources.landed import Seasons, no_rows, read_csv, read_optional, read_required, season_filter, wanted_seasons
from tallyweek.sources.schemas import LANDED
from tallyweek.sources.scoring import column_weights, points_from, read_scoring


def snap_share_from(
    spark: SparkSession, root: str, seasons: Seasons = True, counted: Counter = uncounted
) -> DataFrame | None:
    snaps = read_required(spark, root, "snap_counts", seasons)
    return None if snaps is None else snap_share.snap_share_report(snaps, counted)


def receiving_from(
    spark: SparkSession, root: str, seasons: Seasons = True, counted: Counter = uncounted
) -> DataFrame | None:
    inputs = [read_required(spark, root, table, seasons) for table in ("player_stats", "team_stats", "plays")]
    return None if any(df is None for df in inputs) else receiving.receiving_report(*inputs, counted)


def quarterback_from(
    spark: SparkSession, root: str, seasons: Seasons = True, counted: Counter = uncounted
) -> DataFrame | None:
    stats = read_required(spark, root, "player_stats", seasons)
    if stats is None or quarterback.quarterbacks(stats).isEmpty():
        return None
    plays = read_optional(spark, root, "plays")
    return quarterback.qb_report(stats, None if no_rows(plays, seasons) else season_filter(plays, seasons), counted)


def opportunity_from(
    spark: SparkSession,
    root: str,
    seasons: Seasons = True,
    counted: Counter = uncounted,
    scoring: str | None = None,
    facts: str | None = None,
) -> DataFrame | None:
    """Plays, tracking and combine are optional; ``scoring`` is the path of a weights document, and
    ``facts`` a folder of ``land_facts``, which then takes the place of all tables but the dimensions."""
    players = read_required(spark, root, "players")
    if facts and players is not None:
        return _opportunity_from_facts(spark, root, seasons, players, scoring, facts)
    snaps = read_required(spark, root, "snap_counts", seasons)
    if players is None or snaps is None:
        return None
    optional_tables = ("plays", "tracking_passing", "tracking_receiving", "tracking_rushing", "combine")
    extras = [optional(read_optional(spark, root, t, seasons), LANDED[t], spark) for t in optional_tables]
    weights = column_weights(points_from(read_scoring(spark, scoring)) if scoring else None)
    return opportunity.opportunity_report(snaps, players, *extras, weights=weights, counted=counted)


def _opportunity_from_facts(
    spark: SparkSession, root: str, seasons: Seasons, players: DataFrame, scoring: str | None, folder: str
) -> DataFrame | None:
    facts = Facts.read(spark, folder)
    snaps, stats, *tracking = [season_filter(df, seasons) for df in (facts.snaps, facts.stats, *facts.tracking)]
    if snaps.isEmpty():
        return None
    combine = optional(read_optional(spark, root, "combine"), LANDED["combine"], spark)
    weights = column_weights(points_from(read_scoring(spark, scoring)) if scoring else None)
    return opportunity.report_from_facts(snaps, stats, tracking, players, combine, weights)


def land_facts(spark: SparkSession, root: str, folder: str) -> bool:
    """Land the opportunity report's facts of all seasons in buckets; false where a required table
    has no rows."""
    players, snaps = read_required(spark, root, "players"), read_required(spark, root, "snap_counts")
    if players is None or snaps is None:
        return False
    names = ("plays", "tracking_passing", "tracking_receiving", "tracking_rushing")
    Facts.land(folder, snaps, players, *[optional(read_optional(spark, root, t), LANDED[t], spark) for t in names])
    return True


@dataclass(frozen=True)
class Report:
    """How a report is built, how its files are named and sorted, and what is unique in it.

    Rows whose last key is NULL are people without that id, who are not compared. Two spellings of
    one id are two people wherever the report lists both, so name and position belong to its key."""

    build: Callable[..., DataFrame | None]
    name: str
    sort: list[str]
    key: list[str]


REPORTS = {
    "snap_share": Report(
        snap_share_from, "snap_share_report", snap_share.SORT_COLUMNS,
        ["season", "week", "team", "player", "position", "pfr_player_id"],
    ),
    "receiving": Report(
        receiving_from, "receiving_opportunity", receiving.SORT_COLUMNS,
        ["season", "week", "team", "game_id", "player", "position", "pfr_player_id"],
    ),
    "quarterback": Report(
        quarterback_from, "qb_per_game_stats", quarterback.SORT_COLUMNS,
        ["season", "week", "team", "game_id", "player", "pfr_player_id"],
    ),
    "opportunity": Report(opportunity_from, "opportunity_report", opportunity.SORT_COLUMNS, REPORT_KEY),
}


@dataclass(frozen=True)
class Run:
    """What a run published: rows by season, and rows by stage of its plan."""

    seasons: dict[int | None, int]
    stages: dict[str, int]
    schema: T.StructType

    @property
    def rows(self) -> int:
        return sum(self.seasons.values())


def publish_report(
    spark: SparkSession, name: str, root: str, seasons: Seasons, out: str, fmt: str = "csv", **options
) -> Run | None:
    """Publish one report, or None when a required table has no rows: then nothing is touched.

    The rows are staged and their keys checked on the staged files, of which only the keys are
    read; a season's old files are replaced only after that."""
    report, counts = REPORTS[name], StageCounts()
    df = report.build(spark, root, seasons, counts, **options)
    if df is None:
        return None
    asked = wanted_seasons(seasons) or True
    done = publish(df, f"{out}/{report.name}", report.sort, asked, fmt, [lambda rows: assert_unique(rows, report.key)])
    return Run(done, counts.rows(), df.schema)


def run_report(spark: SparkSession, name: str, root: str, seasons: Seasons, out: str, fmt: str = "csv", **options) -> int | None:
    """``publish_report``, of which only the number of rows is returned."""
    run = publish_report(spark, name, root, seasons, out, fmt, **options)
    return None if run is None else run.rows


def read_weekly_report(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Written opportunity report files of one or more seasons."""
    if fmt == "csv":
        return read_csv(spark, path, opportunity.REPORT_SCHEMA)
    return spark.read.format(fmt).load(path)


def matrix_tables(report: DataFrame, min_games: int = 3, threshold: float = 0.5) -> dict[str, DataFrame]:
    """Everything a heat map is drawn from: the matrices, and cells, colours, texts and lines."""
    parts = matrix.Matrix(report, min_games)
    return {
        "player_order": parts.order,
        "snap_matrix": parts.snap_matrix(),
        "metric_rows": parts.rows,
        "cell_intensity": parts.cell_intensity(),
        "cell_labels": parts.cell_labels(threshold),
        "group_boundaries": parts.group_boundaries(),
    }
