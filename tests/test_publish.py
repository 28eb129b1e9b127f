"""Published seasons: nothing is replaced before its checks, and every interruption can be finished."""

import csv
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from tallyweek.__main__ import main
from tallyweek.operators.counted import StageCounts
from tallyweek.reports import REPORTS, publish_report
from tallyweek.sinks import publish as sink
from tallyweek.sinks.store import Store


@pytest.fixture
def rows(frame):
    def build(*seasons, value=1, copies=1):
        return frame("season int, name string, v int", [{"season": s, "name": f"p{i}", "v": value} for s in seasons for i in range(5) for _ in range(copies)])

    return build


def unique(df):
    from tallyweek.checks import assert_unique

    assert_unique(df, ["season", "name"])


def seen(spark, folder):
    if not glob.glob(f"{folder}/season_p=*"):
        return {}
    return {(r.season_p, r.v): r["count"] for r in spark.read.parquet(folder).groupBy("season_p", "v").count().collect()}


def test_a_failing_check_leaves_the_old_season(spark, rows, tmp_path):
    folder = str(tmp_path / "report")
    assert sink.publish(rows(2020, 2021), folder, ["season", "name"], fmt="parquet", checks=[unique]) == {2020: 5, 2021: 5}
    before = sorted(glob.glob(f"{folder}/season_p=*/*"))
    with pytest.raises(ValueError, match="not unique"):
        sink.publish(rows(2020, value=2, copies=2), folder, ["season", "name"], [2020], "parquet", [unique])
    assert sorted(glob.glob(f"{folder}/season_p=*/*")) == before
    assert sink.published(spark, folder)[2020]["rows"] == 5
    # The next run isn't hindered by what the failed one left.
    assert sink.publish(rows(2020, value=3), folder, ["season", "name"], [2020], "parquet", [unique]) == {2020: 5}
    assert seen(spark, folder) == {(2020, 3): 5, (2021, 1): 5}
    assert {s: e["rows"] for s, e in sink.published(spark, folder).items()} == {2020: 5, 2021: 5}


def test_a_season_without_rows_is_taken_away(spark, rows, tmp_path):
    folder = str(tmp_path / "report")
    sink.publish(rows(2020, 2021, 2022), folder, ["season", "name"], fmt="parquet")
    assert sink.publish(rows(2021), folder, ["season", "name"], [2020, 2021], "parquet") == {2021: 5}
    assert seen(spark, folder) == {(2021, 1): 5, (2022, 1): 5} and set(sink.published(spark, folder)) == {2021, 2022}
    assert sink.publish(rows(), folder, ["season", "name"], True, "parquet") == {}
    assert seen(spark, folder) == {} and sink.published(spark, folder) == {}


@pytest.mark.parametrize("after", range(7))
def test_an_interrupted_swap_is_finished(spark, rows, tmp_path, monkeypatch, after):
    """The run stops before its move, write or drop number ``after`` of the swap."""
    folder = str(tmp_path / "report")
    sink.publish(rows(2020, 2021), folder, ["season", "name"], fmt="parquet")
    steps = []
    for name in ("move", "drop"):

        def step(self, *args, real=getattr(Store, name)):
            if len(steps) == after:
                raise KeyboardInterrupt
            steps.append(args)
            return real(self, *args)

        monkeypatch.setattr(Store, name, step)
    try:
        sink.publish(rows(2020, value=2), folder, ["season", "name"], True, "parquet")
    except KeyboardInterrupt:
        pass
    monkeypatch.undo()
    sink.recover(Store(spark, folder))
    assert seen(spark, folder) == {(2020, 2): 5} and set(sink.published(spark, folder)) == {2020}
    assert sorted(os.path.basename(p) for p in glob.glob(f"{folder}/*")) == ["_manifest", "season_p=2020"]


def test_two_runs_cannot_swap_at_once(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.write("_swap.json", "{}")
    with pytest.raises(Exception, match="(?i)exists"):
        store.write("_swap.json", "{}")
    assert json.loads(store.read("_swap.json")) == {}


def test_every_report_is_checked(spark, landed, tmp_path, monkeypatch):
    for name, report in REPORTS.items():
        run = publish_report(spark, name, landed, 2020, str(tmp_path), "parquet")
        back = spark.read.parquet(f"{tmp_path}/{report.name}")
        assert run.seasons == {2020: back.count()} and set(report.key) <= set(back.columns)
    doubled = REPORTS["receiving"].build

    def twice(*args, **options):
        df = doubled(*args, **options)
        return df.union(df)

    monkeypatch.setitem(REPORTS, "receiving", type(REPORTS["receiving"])(twice, "receiving_opportunity", REPORTS["receiving"].sort, REPORTS["receiving"].key))
    before = sorted(glob.glob(f"{tmp_path}/receiving_opportunity/season_p=*/*"))
    with pytest.raises(ValueError, match="not unique"):
        publish_report(spark, "receiving", landed, 2020, str(tmp_path), "parquet")
    assert sorted(glob.glob(f"{tmp_path}/receiving_opportunity/season_p=*/*")) == before


def test_stages_are_counted(spark, landed, tmp_path):
    tables = {t: spark.read.parquet(f"{landed}/{t}").where("season = 2020") for t in ("snap_counts", "player_stats")}
    run = publish_report(spark, "opportunity", landed, 2020, str(tmp_path))
    assert run.stages["snap rows with ids"] == tables["snap_counts"].count()
    assert run.stages["scored rows"] == run.rows == run.seasons[2020]
    assert run.stages["player profiles"] == spark.read.parquet(f"{landed}/players").count() and run.stages["player games"] > 0
    run = publish_report(spark, "quarterback", landed, 2020, str(tmp_path))
    assert run.stages["quarterback rows"] == tables["player_stats"].where("position = 'QB' AND attempts > 0").count()
    assert run.stages["quarterback rows"] == run.rows and run.stages["play metrics"] > 0
    run = publish_report(spark, "receiving", landed, 2020, str(tmp_path))
    assert run.stages == {"rows with targets": tables["player_stats"].where("targets > 0").count()}
    run = publish_report(spark, "snap_share", landed, 2020, str(tmp_path))
    spans = tables["snap_counts"].select("pfr_player_id", "player", "position", "team").distinct().count()
    assert run.stages == {"spans": spans}


def test_stage_names_are_unique_and_needless_stages_count_nothing(spark):
    counted = StageCounts()
    left, none = counted("left", spark.range(10)), counted("none", spark.range(10).where("false"))
    left.join(none.withColumnRenamed("id", "x"), F.col("id") == F.col("x"), "left").write.format("noop").mode("overwrite").save()
    assert counted.rows() == {"left": 10, "none": 0}
    with pytest.raises(ValueError, match="left"):
        counted("left", spark.range(1))


def test_single_files(spark, landed, tmp_path):
    assert main(["snap_share", "2020,2021", "-i", landed, "-o", str(tmp_path), "--single-files"]) == 0
    for season in (2020, 2021):
        with open(f"{tmp_path}/snap_share_report_{season}.csv", newline="") as file:
            lines = list(csv.DictReader(file))
        assert len(lines) == sink.published(spark, f"{tmp_path}/snap_share_report")[season]["rows"]
        assert {r["season"] for r in lines} == {str(season)}
        order = [(int(r["week"]), r["team"]) for r in lines]
        assert order == sorted(order)
    schema = spark.read.csv(f"{tmp_path}/snap_share_report_2020.csv", header=True).schema
    with pytest.raises(ValueError, match="rows"):
        sink.export_season_file(spark, f"{tmp_path}/snap_share_report", 2020, schema, ["week"], most_rows=1)
    with pytest.raises(ValueError, match="published"):
        sink.export_season_file(spark, f"{tmp_path}/snap_share_report", 1999, schema, ["week"])
