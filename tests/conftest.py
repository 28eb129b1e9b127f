import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyweek.session import tune  # noqa: E402

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def league(spark):
    from tallyweek.sources.derived import League

    return League(spark, TESTDATA)


@pytest.fixture(scope="session")
def landed(league, tmp_path_factory):
    """The derived tables written as landed files."""
    from tallyweek.sources.derived import DERIVATIONS

    root = str(tmp_path_factory.mktemp("landed"))
    for table in DERIVATIONS:
        df = league[table]
        writer = df.write.partitionBy("season") if "season" in df.columns else df.write
        writer.parquet(f"{root}/{table}")
    return root


@pytest.fixture
def frame(spark):
    """Rows of dicts under an explicit schema; absent columns are NULL."""

    def build(schema, rows):
        names = [part.split()[0] for part in schema.split(",")]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    return build
