"""Facts landed once in buckets by player and season, for reports that need no exchange on them.

The change window, the statistics join and the tracking joins of the opportunity report all work on
one player's season. Landed in the same number of buckets on these keys, sorted, each of them finds
its rows in place: a run for another season or another scoring reads buckets and moves nothing.

A bucket holds whole player seasons, a calendar of weeks each, so no key can be hot; the number of
buckets is chosen so that one fits a task (``buckets_for``), and grows with the data.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyweek.plans import opportunity
from tallyweek.plans.team_games import game_opponents
from tallyweek.sinks.store import Store

KEYS = ["player_key", "season"]
LAYOUT = "_layout.json"
TRACKED = ("tracking_passing", "tracking_receiving", "tracking_rushing")
#: Rows of the widest fact that one task sorts and joins at ease.
BUCKET_ROWS = 2_000_000


def buckets_for(rows: int, least: int = 8) -> int:
    return max(least, ceil(rows / BUCKET_ROWS))


def write_bucketed(df: DataFrame, folder: str, name: str, buckets: int, keys: Sequence[str] = KEYS) -> None:
    """Write ``<folder>/<name>`` in buckets. Rows are dealt by the keys first, so that a task writes
    whole buckets and there is one file each. How they lie is noted beside them, since the files
    alone don't say; the note is written last, and tables without it can't be read."""
    spark = df.sparkSession
    path = f"{folder}/{name}"
    table = f"writing_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(table)
    spark.sql(f"DROP TABLE {table}")  # an external table: its files stay
    layout = {"schema": df.schema.jsonValue(), "buckets": buckets, "keys": list(keys)}
    Store(spark, path).write(LAYOUT, json.dumps(layout))


def read_bucketed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of ``write_bucketed``, in any session: its layout is declared anew to this one."""
    path = f"{folder}/{name}"
    layout = json.loads(Store(spark, path).read(LAYOUT))
    schema = T.StructType.fromJson(layout["schema"])
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{k}`" for k in layout["keys"])
    table = f"facts_{name}_{uuid.uuid4().hex}"
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
        f"INTO {layout['buckets']} BUCKETS LOCATION '{place}'"
    )
    return spark.table(table)


@dataclass(frozen=True)
class Facts:
    """The facts of the opportunity report, bucketed alike."""

    snaps: DataFrame
    stats: DataFrame
    tracking: tuple[DataFrame, ...]

    @staticmethod
    def land(
        folder: str, snaps: DataFrame, players: DataFrame, plays: DataFrame, *tracking: DataFrame, buckets: int | None = None
    ) -> None:
        """Derive and write them: snap rows with ids and opponents, play statistics per player and
        game, and the three tracking tables under the player's key. There are three buckets a core
        at least, as a bucket is one task of every later step."""
        buckets = buckets or buckets_for(snaps.count(), least=max(8, 3 * snaps.sparkSession.sparkContext.defaultParallelism))
        rows = opportunity.fill_opponents(opportunity.with_player_ids(snaps, players), game_opponents(plays))
        write_bucketed(rows, folder, "snaps", buckets)
        stats = opportunity.player_game_stats(plays).withColumnRenamed("gsis_id", "player_key")
        write_bucketed(stats, folder, "stats", buckets)
        for name, table in zip(TRACKED, opportunity.tracking_tables(*tracking), strict=True):
            write_bucketed(table.withColumnRenamed("gsis_id", "player_key"), folder, name, buckets)

    @staticmethod
    def read(spark: SparkSession, folder: str) -> Facts:
        tracking = tuple(read_bucketed(spark, folder, name) for name in TRACKED)
        return Facts(read_bucketed(spark, folder, "snaps"), read_bucketed(spark, folder, "stats"), tracking)
