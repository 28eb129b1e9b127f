"""Helpers of the llm operators: tables written to the shared folder, and safe reading of columns."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


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
    return f"{warehouse}/llm-checkpoints"


#: Batches between Spark and Python stay small where rows are wide.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}
#: Settings while a frame is landed: those, and its shuffle files go as soon as it is written, not when
#: the driver next collects its garbage.
LANDING = BATCHES | {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """The runtime settings hold inside the block; those of before come back after it."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def small_batches(spark: SparkSession) -> None:
    """BATCHES for the rest of the session, unless it says otherwise: for frames that the caller writes."""
    for key, value in BATCHES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with settings(spark, LANDING):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def landed_observed(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``landed`` with aggregates of the written rows, taken while writing."""
    observation = Observation()
    table = landed(df.observe(observation, *[c.alias(n) for n, c in measures.items()]), name)
    return table, observation.get


def numbered(df: DataFrame, name: str) -> DataFrame:
    """The frame with a unique ``row`` number, landed: numbers that are computed twice can differ."""
    return landed(df.withColumn("row", F.monotonically_increasing_id()), name)


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def portions(texts: pa.Array | Sequence[bytes], size: int, most: int = 1 << 31) -> Iterator[list[bytes]]:
    """The texts in order, in lists of at most so many bytes and texts; a longer text is a list of its own.
    Of a column, one list at a time is copied out of Arrow."""
    column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary())
    ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        end = min(max(at + 1, int(np.searchsorted(ends, before + size, "right"))), at + most)
        yield column.slice(at, end - at).to_pylist()
        at = end


def give_back() -> None:
    """The freed memory that this process still holds goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """The function for mapInArrow, which gives memory back at the end of its task: Spark uses a worker
    process again for later stages, whose executors need the room."""

    def run_and_give_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return run_and_give_back


def values(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch as tuples of Python values."""
    return zip(*(column.to_pylist() for column in batch.columns), strict=True)
