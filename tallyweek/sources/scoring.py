"""Scoring weights: nested JSON ``Scoring.<Section>.<Stat> = points``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The default points per statistic.
DEFAULT_POINTS = {
    "Passing": {
        "PassingYards_PY": 0.04,
        "TouchdownPass_PTD": 4.0,
        "InterceptionsThrown_INT": -2.0,
        "TwoPointPassingConversion_2PC": 2.0,
    },
    "Rushing": {
        "RushingYards_RY": 0.1,
        "TouchdownRush_RTD": 6.0,
        "TwoPointRushingConversion_2PR": 2.0,
    },
    "Receiving": {
        "ReceivingYards_REY": 0.1,
        "Reception_REC": 0.5,
        "TouchdownReception_RETD": 6.0,
        "TwoPointReceivingConversion_2PRE": 2.0,
    },
}

# Which report column each scored statistic applies to, in the order of the sum.
# The rushing two-point weight is configured but scores nothing.
SCORED_COLUMNS = {
    "passing_yards": ("Passing", "PassingYards_PY"),
    "pass_touchdowns": ("Passing", "TouchdownPass_PTD"),
    "interceptions": ("Passing", "InterceptionsThrown_INT"),
    "pass_2pt_conversions": ("Passing", "TwoPointPassingConversion_2PC"),
    "rushing_yards": ("Rushing", "RushingYards_RY"),
    "rush_touchdowns": ("Rushing", "TouchdownRush_RTD"),
    "receiving_yards": ("Receiving", "ReceivingYards_REY"),
    "receptions": ("Receiving", "Reception_REC"),
    "receiving_touchdowns": ("Receiving", "TouchdownReception_RETD"),
    "receiving_2pt_conversions": ("Receiving", "TwoPointReceivingConversion_2PRE"),
}


def read_scoring(spark: SparkSession, path: str) -> DataFrame:
    """The document as rows (section, stat, points)."""
    document = spark.read.schema("Scoring MAP<STRING, MAP<STRING, DOUBLE>>").json(path, multiLine=True)
    sections = document.select(F.explode("Scoring").alias("section", "stats"))
    return sections.select("section", F.explode("stats").alias("stat", "points"))


def points_from(scoring: DataFrame) -> dict[str, dict[str, float]]:
    """The configured points as literals; one row per configured statistic, a few dozen at most."""
    points: dict[str, dict[str, float]] = {}
    for row in scoring.collect():
        points.setdefault(row.section, {})[row.stat] = row.points
    return points


def column_weights(points: dict[str, dict[str, float]] | None = None) -> dict[str, float]:
    """Report column -> points, in the order in which they are summed."""
    points = DEFAULT_POINTS if points is None else points
    return {column: points[section][stat] for column, (section, stat) in SCORED_COLUMNS.items()}
