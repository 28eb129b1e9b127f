"""Publishing a report's seasons: staged, checked, then swapped in season by season.

Readers of ``<folder>/<report>/season_p=<season>/`` see a season as it was until its new files have
passed their checks. A run goes through these states, each of which a later run can pick up:

1. *staged*: the files lie in ``_stage-<run>``, which Spark's readers don't list. A run that fails
   here or in its checks leaves the published seasons untouched.
2. *decided*: ``_swap.json`` says which seasons are put in place and which are taken away. It is
   created only if it isn't there, so two runs can't swap at once. From here on a run that was
   interrupted is carried to its end by the next one.
3. *published*: every season has been renamed into place, and a new ``_manifest/<number>.json`` lists
   the seasons with their rows. The files that were replaced go last.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweek.sinks.store import Store

log = logging.getLogger(__name__)

PARTITION = "season_p"
STAGE, OLD, SWAP, MANIFEST = "_stage-", "_old-", "_swap.json", "_manifest"

Check = Callable[[DataFrame], None]


def _place(season: int | None) -> str:
    return f"{PARTITION}={'__HIVE_DEFAULT_PARTITION__' if season is None else season}"


def _season(place: str) -> int | None:
    value = place.split("=")[1]
    return int(value) if value.lstrip("-").isdigit() else None


def read_files(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    """Season files with their partition column, read with the schema they were written with. A bare
    empty field of a CSV is NULL and a quoted one the empty string."""
    kinds = T.StructType([*schema.fields, T.StructField(PARTITION, T.IntegerType())])
    reader = spark.read.schema(kinds).format(fmt)
    return (reader.options(header=True, enforceSchema=False, nullValue="\u0000") if fmt == "csv" else reader).load(path)


def stage(df: DataFrame, path: str, sort: Sequence[str], fmt: str) -> int:
    """Write the season folders below a path and return the number of rows.

    The season stays a column of the rows; a copy becomes the partition. A range partition on the
    whole sort order spreads a large season over many tasks and still leaves every file sorted
    and the files in order. The row count is observed while writing, without a second job.
    """
    observation = Observation()
    order = [PARTITION, *[c for c in sort if c != PARTITION]]
    # Observed above the sort: what is below it also runs for the sampling of the range bounds.
    rows = df.withColumn(PARTITION, F.col("season")).orderBy(*order)
    rows = rows.observe(observation, F.count("*").alias("rows"))
    writer = rows.write.partitionBy(PARTITION)
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)
    return int(observation.get["rows"])


def published(spark: SparkSession, folder: str) -> dict[int | None, dict]:
    """Season -> rows, run and time, by the newest manifest."""
    store = Store(spark, folder)
    found = store.names(MANIFEST)
    return {_season(place): entry for place, entry in json.loads(store.read(f"{MANIFEST}/{found[-1]}")).items()} if found else {}


def _finish(store: Store) -> None:
    """Carry a decided swap to its end; every step can be done again."""
    plan = json.loads(store.read(SWAP))
    run, staged, entries = plan["run"], f"{STAGE}{plan['run']}", plan["seasons"]
    waiting = set(store.names(staged, PARTITION))
    for place in [*waiting, *plan["gone"]]:
        if store.exists(place):
            store.move(place, f"{OLD}{run}/{place}")
    for place in sorted(waiting):
        store.move(f"{staged}/{place}", place)
    found = store.names(MANIFEST)
    if not found or run not in found[-1]:
        number = int(found[-1].split("-")[0]) + 1 if found else 1
        before = json.loads(store.read(f"{MANIFEST}/{found[-1]}")) if found else {}
        kept = {place: e for place, e in before.items() if place not in plan["gone"]}
        store.write(f"{MANIFEST}/{number:08d}-{run}.json", json.dumps(kept | entries, indent=1))
    for place in (staged, f"{OLD}{run}", SWAP):
        store.drop(place)


def recover(store: Store) -> None:
    """Finish the swap of a run that was interrupted."""
    if store.exists(SWAP):
        log.warning("%s: finishing an interrupted publication", store.folder)
        _finish(store)


def publish(
    df: DataFrame, folder: str, sort: Sequence[str], seasons: Sequence[int] | bool = True, fmt: str = "csv", checks: Sequence[Check] = ()
) -> dict[int | None, int]:
    """Replace the seasons of a report and return their rows.

    ``seasons`` are those the run is about (True: all): such as are published but have no rows any
    more are taken away, others stay as they are. Every check gets the rows as they are read back
    from the staged files and raises an error where they break a contract.
    """
    spark = df.sparkSession
    store = Store(spark, folder)
    recover(store)
    run = uuid.uuid4().hex
    path = store.at(f"{STAGE}{run}")
    written = stage(df, path, sort, fmt)
    back = read_files(spark, path, df.schema, fmt) if written else None
    counts = {r[0]: r[1] for r in back.groupBy(PARTITION).count().collect()} if written else {}
    if sum(counts.values()) != written:
        raise ValueError(f"{path}: {written} rows were written, {sum(counts.values())} can be read")
    for check in checks if written else ():
        check(back)
    places = {_place(season): rows for season, rows in counts.items()}
    asked = None if seasons is True else {_place(s) for s in seasons}
    gone = [p for p in store.names(prefix=f"{PARTITION}=") if p not in places and (asked is None or p in asked)]
    now = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
    entries = {place: {"rows": rows, "run": run, "published_at": now} for place, rows in places.items()}
    store.write(SWAP, json.dumps({"run": run, "seasons": entries, "gone": gone}))
    _finish(store)
    log.info("%s: %s", folder, counts)
    return counts


def export_season_file(spark: SparkSession, folder: str, season: int, schema: T.StructType, sort: Sequence[str], most_rows: int = 5_000_000) -> str:
    """One CSV file ``<folder>_<season>.csv`` of a published season, for tools that read single files.

    A single file is written by a single task, so a season of more rows than ``most_rows`` (by the
    manifest) is refused; its folder of sorted files holds the same rows."""
    entry = published(spark, folder).get(season)
    if entry is None or entry["rows"] > most_rows:
        raise ValueError(f"{folder}: season {season} " + ("isn't published" if entry is None else f"has {entry['rows']} rows"))
    store = Store(spark, folder)
    target, draft = f"{store.folder}_{season}.csv", f"_file-{uuid.uuid4().hex}"
    rows = read_files(spark, store.at(_place(season)), schema, "csv").select(*schema.names)
    rows.coalesce(1).sortWithinPartitions(*sort).write.option("header", True).csv(store.at(draft))
    (part,) = store.names(draft, "part-")
    name = target.rsplit("/", 1)[1]
    store.drop(f"../{name}")
    store.move(f"{draft}/{part}", f"../{name}")
    store.drop(draft)
    return target
