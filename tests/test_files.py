import glob
import json

import pytest

from tallyweek.__main__ import main
from tallyweek.reports import REPORTS, matrix_tables, read_weekly_report, run_report
from tallyweek.plans import opportunity
from tallyweek.sinks.landing import land, shared_folder
from tallyweek.sources.landed import parse_seasons, read_csv, read_optional, read_parquet, read_required, season_filter
from tallyweek.sources.scoring import DEFAULT_POINTS, column_weights, points_from, read_scoring


def test_season_choices(frame):
    assert parse_seasons("all") is True and parse_seasons("2024") == 2024 and parse_seasons("2023, 2024") == [2023, 2024]
    df = frame("season int", [{"season": s} for s in (2022, 2023, 2024)])
    picked = lambda choice: sorted(r.season for r in season_filter(df, choice).collect())
    assert picked(True) == [2022, 2023, 2024] and picked(2023) == [2023] and picked([2024, 2022]) == [2022, 2024]


def test_season_choice_prunes_partitions(spark, landed):
    plan = read_parquet(spark, landed, "plays", 2021)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan


def test_required_and_optional_tables(spark, landed):
    assert read_required(spark, landed, "snap_counts", 1999) is None
    assert read_required(spark, landed, "snap_counts", 2020) is not None
    missing = read_optional(spark, landed + "/nowhere", "combine")
    assert missing.isEmpty() and "forty" in missing.columns
    assert run_report(spark, "receiving", landed, 1999, landed + "/never") is None


def test_scoring_document(spark, tmp_path):
    path = tmp_path / "weights.json"
    sections = {**DEFAULT_POINTS, "Receiving": {**DEFAULT_POINTS["Receiving"], "Reception_REC": 1}}
    path.write_text(json.dumps({"Scoring": sections}, indent=2))
    points = points_from(read_scoring(spark, str(path)))
    assert points == sections
    assert column_weights(points)["receptions"] == 1.0 and column_weights()["receptions"] == 0.5
    assert list(column_weights())[:2] == ["passing_yards", "pass_touchdowns"]


@pytest.mark.parametrize("name", list(REPORTS))
def test_written_reports_read_back(spark, landed, tmp_path, name):
    out = str(tmp_path)
    rows = run_report(spark, name, landed, [2020, 2021], out)
    expected = REPORTS[name].build(spark, landed, [2020, 2021])
    (folder,) = glob.glob(f"{out}/*")
    back = read_csv(spark, folder, expected.schema)
    assert sorted(glob.glob(f"{folder}/season_p=*")) == [f"{folder}/season_p=2020", f"{folder}/season_p=2021"]
    columns = expected.columns
    key = lambda r: tuple(str(v) for v in r)
    written = sorted((tuple(r) for r in back.select(*columns).collect()), key=key)
    assert written == sorted((tuple(r) for r in expected.collect()), key=key)
    assert len(written) == rows
    sort = [c for c in REPORTS[name].sort if c != "season"]
    for path in glob.glob(f"{folder}/season_p=*/*.csv"):
        one = [tuple(r) for r in read_csv(spark, path, expected.schema).select(*sort).collect()]
        assert one == sorted(one, key=lambda t: tuple((v is not None, v) for v in t))


def test_matrix_from_written_report(spark, landed, tmp_path):
    out = str(tmp_path)
    assert main(["opportunity", "all", "-i", landed, "-o", out]) == 0
    report = read_weekly_report(spark, f"{out}/opportunity_report")
    tables = matrix_tables(report)
    assert tables["snap_matrix"].count() == 7 * tables["player_order"].count()
    labels = tables["cell_labels"].where("metric = 'offense_snap_share'").first()
    assert labels.text == f"{labels.value * 100:.0f}%"
    assert main(["matrix", "-i", f"{out}/opportunity_report", "-o", f"{out}/matrix"]) == 0
    assert spark.read.parquet(f"{out}/matrix/group_boundaries").count() > 0
    assert len(report.columns) == len(opportunity.REPORT_COLUMNS) + 1


def test_landing_uses_one_shared_folder(spark, frame):
    df = land(frame("x int", [{"x": 1}]), "check")
    assert f"{shared_folder(spark).removeprefix('file:')}/check-" in df.inputFiles()[0]


@pytest.mark.parametrize("name", list(REPORTS))
def test_a_run_replaces_only_its_own_seasons(spark, landed, tmp_path, name):
    out = str(tmp_path)
    counts = {season: run_report(spark, name, landed, season, out, "parquet") for season in (2020, 2021, 2020)}
    (folder,) = glob.glob(f"{out}/*")
    back = {r.season_p: r["count"] for r in spark.read.parquet(folder).groupBy("season_p").count().collect()}
    assert back == counts and all(counts.values())


def test_an_unreadable_optional_table_is_an_error(spark, tmp_path):
    (tmp_path / "combine").mkdir()
    (tmp_path / "combine" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)footer|parquet"):
        read_optional(spark, str(tmp_path), "combine").collect()
