"""Landed tables whose seasons spell their columns differently, read as one table.

Feeds rename columns from one season to the next. All spellings are read, those that a file lacks
as NULL, and the first filled one counts, so one scan with one schema serves all seasons. Numbers
of a smaller type are widened by the reader.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweek.sinks.store import Store
from tallyweek.sources.footers import columns_by_folder
from tallyweek.sources.schemas import LANDED

log = logging.getLogger(__name__)

# Other spellings of a table's columns, the preferred one first.
SPELLINGS: dict[str, dict[str, list[str]]] = {
    "player_stats": {"player_display_name": ["player_name"], "opponent_team": ["opponent"]},
    "players": {"display_name": ["full_name", "player_name"]},
    "snap_counts": {"player": ["player_name"]},
}


def _folders(spark: SparkSession, root: str, table: str) -> list[str]:
    """The season folders of a table, or the table itself where it isn't partitioned."""
    names = Store(spark, root).names(table, "season=")
    return [f"{root}/{table}/{n}" for n in names] or [f"{root}/{table}"]


def needs_reconciling(spark: SparkSession, root: str, table: str) -> bool:
    """Whether the table's seasons differ in their columns, or spell one otherwise."""
    found = [set(c) for c in columns_by_folder(spark, _folders(spark, root, table)).values()]
    others = {other for names in SPELLINGS.get(table, {}).values() for other in names}
    return any(names != found[0] or names & others for names in found)


def read_reconciled(spark: SparkSession, root: str, table: str, required: tuple[str, ...] = ()) -> DataFrame:
    """The table under its known columns, whatever its seasons call them.

    A column that no season has is left out, as is the rule for tables read plainly; a required one
    is an error. Where only some seasons have it, it is NULL in the others."""
    folders = _folders(spark, root, table)
    by_folder = {folder: set(names) for folder, names in columns_by_folder(spark, folders).items()}
    partitioned = folders != [f"{root}/{table}"]
    everything = set().union(*by_folder.values()) | ({"season"} if partitioned else set())
    fields, chosen = [], []
    for field in LANDED[table].fields:
        spellings = [s for s in (field.name, *SPELLINGS.get(table, {}).get(field.name, ())) if s in everything]
        if not spellings:
            if field.name in required:
                raise ValueError(f"{table}: no season has the column {field.name}")
            continue
        lacking = [f for f, names in by_folder.items() if not names & set(spellings) and not (partitioned and field.name == "season")]
        if lacking:
            log.warning("%s: %s is NULL in %s", table, field.name, lacking)
        fields += [T.StructField(s, field.dataType) for s in spellings]
        chosen.append(F.coalesce(*spellings).alias(field.name) if len(spellings) > 1 else F.col(spellings[0]).alias(field.name))
    unique = {f.name: f for f in fields}
    try:
        return spark.read.schema(T.StructType(list(unique.values()))).parquet(f"{root}/{table}").select(*chosen)
    except AnalysisException as error:
        raise ValueError(f"{table} can't be read from {root}") from error
