"""Reading landed tables by name, with the season choice as a pushed-down filter."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from tallyweek.sinks.landing import shared_folder
from tallyweek.sources.footers import has_rows
from tallyweek.sources.reconcile import needs_reconciling, read_reconciled
from tallyweek.sources.schemas import LANDED

log = logging.getLogger(__name__)

Seasons = int | Iterable[int] | bool


def parse_seasons(text: str) -> Seasons:
    """``all``, a year, or comma-separated years."""
    if text.strip().lower() == "all":
        return True
    years = [int(part) for part in text.split(",")]
    return years if "," in text else years[0]


def season_filter(df: DataFrame, seasons: Seasons) -> DataFrame:
    """True keeps every season; a number or several numbers keep those."""
    if seasons is True or "season" not in df.columns:
        return df
    return df.where(F.col("season").isin(wanted_seasons(seasons)))


def wanted_seasons(seasons: Seasons) -> list[int] | None:
    """The seasons in order; None for all."""
    return None if seasons is True else [seasons] if isinstance(seasons, int) else sorted(set(seasons))


def _whole(spark: SparkSession, root: str, table: str) -> DataFrame:
    plain = spark.read.parquet(f"{root}/{table}")
    return read_reconciled(spark, root, table) if table in LANDED and needs_reconciling(spark, root, table) else plain


def read_parquet(spark: SparkSession, root: str, table: str, seasons: Seasons = True) -> DataFrame:
    """A landed table ``<root>/<table>`` (a file, a folder, or season-partitioned folders).

    Columns beyond the known ones are kept in the relation and pruned by the optimizer, unless
    the seasons of the table differ: then it has the known ones, under one spelling.
    """
    return season_filter(_whole(spark, root, table), seasons)


def no_rows(table: DataFrame, seasons: Seasons = True) -> bool:
    """Whether an unfiltered table has no rows of the seasons: by its files' footers, and where
    those can't tell, by a job that ends at the first row."""
    found = has_rows(table, wanted_seasons(seasons) if "season" in table.columns else None)
    return season_filter(table, seasons).isEmpty() if found is None else not found


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV with a header and a given schema, so no pass over the data infers types.

    A bare empty field is NULL and a quoted one the empty string; with Spark's default null
    marker both would be NULL.
    """
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False, nullValue="\u0000")


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, rejects: str) -> tuple[DataFrame, int]:
    """A CSV as ``read_csv`` reads it, without the rows that break the schema, and their number.

    Rows with a field too few or too many or of another type are written as they are to ``rejects``
    with the file they come from. The file is parsed once: good rows are landed by the same job."""
    broken = "__broken"
    kinds = T.StructType([*schema.fields, T.StructField(broken, T.StringType())])
    parsed = spark.read.schema(kinds).csv(
        path, header=True, enforceSchema=False, nullValue="\u0000", mode="PERMISSIVE", columnNameOfCorruptRecord=broken
    )
    bad = F.col(broken).isNotNull()
    counts = Observation()
    rows = parsed.withColumns({"__file": F.input_file_name(), "__bad": bad}).observe(counts, F.count_if(bad).alias("bad"))
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    rows.write.partitionBy("__bad").parquet(folder)
    split = spark.read.schema(T.StructType([*kinds.fields, T.StructField("__file", T.StringType()), T.StructField("__bad", T.BooleanType())])).parquet(folder)
    number = int(counts.get["bad"])
    if number:
        log.warning("%s: %d rows break the schema", path, number)
        split.where("__bad").select(F.col(broken).alias("line"), F.col("__file").alias("file")).write.mode("append").parquet(rejects)
    return split.where("NOT __bad").select(*schema.names), number


def read_optional(spark: SparkSession, root: str, table: str, seasons: Seasons = True) -> DataFrame:
    """An optional table: its rows, or no rows with its fixed schema where there is no such table.

    Only a missing or empty folder counts as absent; a table that can't be read is an error."""
    try:
        return read_parquet(spark, root, table, seasons)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        log.warning("optional table %s is absent: its columns stay NULL", table)
        return spark.createDataFrame([], LANDED[table])


def read_required(spark: SparkSession, root: str, table: str, seasons: Seasons = True) -> DataFrame | None:
    """A required table, or None when it holds no row for the seasons: then there is no report."""
    whole = _whole(spark, root, table)
    return None if no_rows(whole, seasons) else season_filter(whole, seasons)
