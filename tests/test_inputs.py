"""Inputs of differing shape: footers, spellings by season, broken CSV rows."""

import pytest
from pyspark.sql import functions as F

from tallyweek.reports import receiving_from
from tallyweek.sources import landed as source
from tallyweek.sources.footers import has_rows
from tallyweek.sources.reconcile import needs_reconciling, read_reconciled


def jobs_of(spark, action):
    """The number of Spark jobs that an action runs."""
    group = f"jobs-{id(action)}"
    spark.sparkContext.setJobGroup(group, "")
    try:
        action()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_footers_tell_whether_there_are_rows(spark, landed, tmp_path):
    snaps = spark.read.parquet(f"{landed}/snap_counts")
    assert has_rows(snaps) is True and has_rows(snaps, [2020]) is True and has_rows(snaps, [1999]) is False
    # Not partitioned: row groups of one season tell, mixed ones don't.
    for name, df in {"one": snaps.where("season = 2020"), "mixed": snaps.coalesce(1), "none": snaps.where("false")}.items():
        df.write.parquet(f"{tmp_path}/{name}")
    one, mixed, none = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("one", "mixed", "none"))
    assert has_rows(one, [2020]) is True and has_rows(one, [2021]) is False
    assert has_rows(mixed, [2021]) is None and has_rows(mixed, [1990]) is False and has_rows(mixed) is True
    assert has_rows(none) is False and has_rows(none, [2020]) is False
    assert source.no_rows(mixed, 2021) is False and source.no_rows(none, 2021) is True


def test_a_required_table_with_rows_is_not_scanned(spark, landed):
    tables = {t: source.read_parquet(spark, landed, t) for t in ("snap_counts", "players")}
    for table in tables.values():
        assert jobs_of(spark, lambda table=table: source.no_rows(table, 2020)) == 0


@pytest.fixture
def respelled(spark, landed, tmp_path):
    """The statistics with one season spelled otherwise, and one column of a smaller type."""
    stats = spark.read.parquet(f"{landed}/player_stats")
    for season in (2020, 2021, 2022):
        rows = stats.where(F.col("season") == season).drop("season")
        if season == 2021:
            rows = rows.withColumnsRenamed({"player_display_name": "player_name", "opponent_team": "opponent"})
            rows = rows.withColumn("week", F.col("week").cast("smallint"))
        rows.write.parquet(f"{tmp_path}/player_stats/season={season}")
    for table in ("team_stats", "plays"):
        spark.read.parquet(f"{landed}/{table}").write.partitionBy("season").parquet(f"{tmp_path}/{table}")
    return str(tmp_path)


def test_seasons_spelled_differently_are_read_in_one_run(spark, landed, respelled):
    assert needs_reconciling(spark, respelled, "player_stats") and not needs_reconciling(spark, landed, "player_stats")
    got = receiving_from(spark, respelled)
    expected = receiving_from(spark, landed)
    assert got.columns == expected.columns
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    plan = source.read_parquet(spark, respelled, "player_stats", 2021)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan


def test_missing_columns(spark, landed, tmp_path):
    stats = spark.read.parquet(f"{landed}/player_stats").where("season = 2020")
    stats.drop("season", "targets").write.parquet(f"{tmp_path}/player_stats/season=2020")
    stats.drop("season").write.parquet(f"{tmp_path}/player_stats/season=2021")
    df = read_reconciled(spark, str(tmp_path), "player_stats", required=("targets",))
    assert df.where("season = 2020 AND targets IS NOT NULL").isEmpty() and not df.where("season = 2021 AND targets > 0").isEmpty()
    stats.drop("season", "targets").write.parquet(f"{tmp_path}/more/player_stats/season=2020")
    with pytest.raises(ValueError, match="targets"):
        read_reconciled(spark, f"{tmp_path}/more", "player_stats", required=("targets",))


def test_broken_csv_rows_are_set_apart(spark, tmp_path):
    from tallyweek.sources.schemas import struct_of

    schema = struct_of({"season": "int", "name": "string", "share": "double"})
    path = tmp_path / "rows.csv"
    path.write_text('season,name,share\n2020,a,0.5\nbroken,b,0.5\n2020,"",\n2020,c\n2021,d,0.25,more\n2021,e,x\n2021,f,1\n')
    good, bad = source.read_csv_checked(spark, str(path), schema, f"{tmp_path}/rejects")
    assert good.schema == schema and bad == 4
    assert sorted((tuple(r) for r in good.collect()), key=str) == [(2020, "", None), (2020, "a", 0.5), (2021, "f", 1.0)]
    rejects = spark.read.parquet(f"{tmp_path}/rejects").collect()
    assert sorted(r.line for r in rejects) == ["2020,c", "2021,d,0.25,more", "2021,e,x", "broken,b,0.5"]
    assert {r.file.rsplit("/", 1)[1] for r in rejects} == {"rows.csv"}
    whole, none = source.read_csv_checked(spark, str(path.with_name("good.csv")) if path.with_name("good.csv").write_text("season,name,share\n2020,a,1\n") else "", schema, f"{tmp_path}/never")
    assert none == 0 and whole.count() == 1 and not (tmp_path / "never").exists()
