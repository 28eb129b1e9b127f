"""Landing a table in the shared folder: a file boundary between two reports.

A written table survives lost executors, is scanned with column pruning by each of its readers,
and keeps what it holds from being computed once per reader.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset, one inside the warehouse. A
    warehouse on the driver's own disk is an error, unless Spark runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse, master = spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master
    path = spark._jvm.org.apache.hadoop.fs.Path(warehouse)
    is_local = path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme() == "file"
    if is_local and master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/landed"


def land_observed(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """Write the frame once and read it back, with aggregates of the rows that are taken while
    writing: its ``rows``, which are logged, and the given measures."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    observed = Observation()
    all_measures = {"rows": F.count("*"), **measures}
    df.observe(observed, *[c.alias(n) for n, c in all_measures.items()]).write.parquet(path)
    values = observed.get
    log.info("%s: %d rows", name, values["rows"])
    return spark.read.schema(df.schema).parquet(path), values


def land(df: DataFrame, name: str) -> DataFrame:
    """``land_observed`` without measures."""
    return land_observed(df, name)[0]
