"""What the physical plans must and must not contain, with broadcasts switched off."""

import re

import pytest

import __spark_entry__ as entry
from tallyweek.plans import matrix, opportunity, quarterback, rushing, snap_share
from tests.conftest import TESTDATA


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(entry.REGISTERED))
def test_no_cross_join_no_python(spark, no_broadcast, name):
    plan = plan_of(entry.queries()[name](spark, TESTDATA))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "InPandas"):
        assert operator not in plan


def test_snap_report_shuffles(spark, landed, no_broadcast):
    snaps = spark.read.parquet(f"{landed}/snap_counts")
    plan = plan_of(snap_share.snap_share_report(snaps)).split("SubqueryAdaptiveBroadcast")[0]
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    on_player = [s for s in shuffles if "person" in s]
    # spans, grid and observations; the join and the window share the latter two
    assert len(on_player) == 3
    assert "ReadSchema: struct<week:int,player:string,pfr_player_id:string,position:string,team:string>" in plan


def test_metrics_join_and_window_share_a_shuffle(spark, landed, no_broadcast):
    stats, plays = spark.read.parquet(f"{landed}/player_stats"), spark.read.parquet(f"{landed}/plays")
    plan = plan_of(quarterback.qb_report(stats, plays))
    window = plan.index("Window [lag(")
    join = plan.index("SortMergeJoin", window)
    assert "Exchange" not in plan[window:join]


def test_filters_reach_the_scan(spark, landed):
    stats = spark.read.parquet(f"{landed}/player_stats")
    plan = plan_of(quarterback.quarterbacks(stats))
    assert "PushedFilters: [IsNotNull(position), IsNotNull(attempts), EqualTo(position,QB), GreaterThan(attempts,0.0)]" in plan


def test_opportunity_scans_and_shuffles(spark, landed, no_broadcast):
    names = ("snap_counts", "players", "plays", "tracking_passing", "tracking_receiving", "tracking_rushing", "combine")
    plan = plan_of(opportunity.opportunity_report(*[spark.read.parquet(f"{landed}/{n}") for n in names]))
    # Play statistics were aggregated once, into the landed scored rows; ranking and report read those.
    assert "/plays" not in plan
    assert plan.count("Exchange hashpartitioning") <= 25


@pytest.fixture
def parts(spark, landed):
    names = ("snap_counts", "players", "plays", "tracking_passing", "tracking_receiving")
    return matrix.Matrix(opportunity.matrix_input(*[spark.read.parquet(f"{landed}/{n}") for n in names]))


def test_matrix_input_derives_nothing_else(spark, landed, no_broadcast):
    names = ("snap_counts", "players", "plays", "tracking_passing", "tracking_receiving")
    plan = plan_of(opportunity.matrix_input(*[spark.read.parquet(f"{landed}/{n}") for n in names]))
    assert "lag(" not in plan and "rush_touchdown" not in plan and "combine" not in plan


def test_row_places_shuffles(spark, parts, no_broadcast):
    """Ordering the rows: one exchange before they are landed by range, and few after."""
    order = parts.order
    before = plan_of(parts.regulars.groupBy("season", "player_name").count()).count("Exchange")
    assert before == 1 and plan_of(order).count("Exchange hashpartitioning") + before + 1 <= 8


def test_building_the_matrix_runs_no_job(spark, parts):
    regulars, order, weeks = parts.regulars, parts.order, parts.weeks
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    built = matrix.snap_matrix(regulars, order, weeks)
    assert list(tracker.getJobIdsForGroup("building")) == []
    built.collect()
    assert list(tracker.getJobIdsForGroup("building"))
    spark.sparkContext._jsc.clearJobGroup()


def test_cells_are_derived_once(spark, parts, no_broadcast):
    plan = plan_of(parts.cell_intensity())
    assert "min_by" not in plan and "metric_rows-" in plan


def test_no_raw_play_reaches_the_join(spark, landed, no_broadcast):
    plays, players = spark.read.parquet(f"{landed}/plays"), spark.read.parquet(f"{landed}/players")
    for df, keys in ((rushing.rushing_totals(plays, players), 1), (rushing.rushing_by_week(plays, players), 2)):
        plan = plan_of(df)
        branch = plan[: plan.index("/plays")].split("SortMergeJoin")[-1]
        # Between the scan of plays and the join there are aggregates on the rusher.
        assert branch.count("HashAggregate(keys=[rusher_player_id") >= 2


def test_snap_labels_need_no_window_over_the_grid(spark, landed, no_broadcast):
    plan = plan_of(snap_share.snap_share_report(spark.read.parquet(f"{landed}/snap_counts"))).split("SubqueryAdaptiveBroadcast")[0]
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and plan.index("Window [lag(") < plan.index("Generate explode") < plan.index("Window [min(")
