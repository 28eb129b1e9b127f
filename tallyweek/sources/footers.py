"""What the footers of Parquet files tell, without a scan: whether a table has rows, and its columns."""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator

from pyspark.sql import DataFrame, SparkSession

#: Most footers that the driver opens before it leaves the answer to a job.
MOST_FOOTERS = 64
_SEASON = re.compile(r"/season=([^/]+)/")


def _footers(spark: SparkSession, paths: Iterator[str]) -> Iterator[tuple[str, object]]:
    """(path, metadata) of each file."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
        try:
            yield path, reader.getFooter()
        finally:
            reader.close()


def _bounds(block, column: str) -> tuple[int, int] | None:
    """Least and greatest value of a row group's column, where they were written."""
    for chunk in block.getColumns():
        if chunk.getPath().toDotString() == column:
            statistics = chunk.getStatistics()
            return (statistics.genericGetMin(), statistics.genericGetMax()) if statistics.hasNonNullValue() else None
    return None


def has_rows(table: DataFrame, seasons: Collection[int] | None = None) -> bool | None:
    """Whether an unfiltered Parquet table has rows (of the seasons); None where footers can't tell.

    Seasons are known by their folders or by a row group that holds a single one. The first footer
    with rows ends the search, so a table that has rows costs one or a few reads of some kilobytes."""
    paths = table._jdf.inputFiles()  # stays in the JVM; names are fetched one by one
    unsure = False
    wanted = None if seasons is None else {str(s) for s in seasons}
    looked = 0

    def chosen() -> Iterator[str]:
        for i in range(min(len(paths), 100 * MOST_FOOTERS)):
            folder = _SEASON.search(paths[i])
            if wanted is None or not folder or folder[1] in wanted:
                yield paths[i]

    for path, footer in _footers(table.sparkSession, chosen()):
        if (looked := looked + 1) > MOST_FOOTERS:
            return None
        in_season = wanted is None or _SEASON.search(path)
        for block in footer.getBlocks():
            if not block.getRowCount():
                continue
            if in_season:
                return True
            bounds = _bounds(block, "season")
            if bounds and bounds[0] == bounds[1] and bounds[0] in seasons:
                return True
            unsure = unsure or bounds is None or any(bounds[0] <= s <= bounds[1] for s in seasons)
    return None if unsure or len(paths) > 100 * MOST_FOOTERS else False


def columns_by_folder(spark: SparkSession, folders: Collection[str]) -> dict[str, list[str]]:
    """The columns of each folder by one of its files: a landing writes all files of a season alike."""
    return {folder: spark.read.parquet(folder).columns for folder in folders}
