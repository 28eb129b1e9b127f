"""Adapting to the columns a source really has."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def select_available(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """Keep the wanted columns that exist, in the wanted order."""
    return df.select(*[name for name in wanted if name in df.columns])


def first_available(df: DataFrame, names: Iterable[str], default: Column | None = None) -> Column:
    """The first existing column of several spellings; without one, the default or an error."""
    names = list(names)
    for name in names:
        if name in df.columns:
            return F.col(name)
    if default is not None:
        return default
    raise ValueError(f"none of the columns {names} is present")


def optional(df: DataFrame | None, schema: T.StructType, spark=None) -> DataFrame:
    """An optional source with a fixed schema: absent columns are NULL, an absent source is empty."""
    if df is None:
        if spark is None:
            from pyspark.sql import SparkSession

            spark = SparkSession.getActiveSession()
        return spark.createDataFrame([], schema)
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )
