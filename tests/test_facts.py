"""Facts in buckets: the same report, and nothing moved on the player's season."""

import json
import re

import pytest

from tallyweek.__main__ import main
from tallyweek.plans import opportunity
from tallyweek.sinks.facts import Facts, buckets_for, read_bucketed, write_bucketed

NAMES = ("snap_counts", "players", "plays", "tracking_passing", "tracking_receiving", "tracking_rushing")


@pytest.fixture(scope="module")
def inputs(spark, landed):
    return [spark.read.parquet(f"{landed}/{n}") for n in NAMES], spark.read.parquet(f"{landed}/combine")


@pytest.fixture(scope="module")
def facts(spark, inputs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("facts"))
    Facts.land(folder, *inputs[0], buckets=6)
    return Facts.read(spark, folder)


def test_the_report_is_the_same(spark, inputs, facts):
    (snaps, players, plays, *tracking), combine = inputs
    expected = opportunity.opportunity_report(snaps, players, plays, *tracking, combine)
    got = opportunity.report_from_facts(facts.snaps, facts.stats, facts.tracking, players, combine)
    assert got.schema == expected.schema
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_no_exchange_on_the_player_season(spark, inputs, facts):
    players = inputs[0][1]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scored = opportunity.scored_from_facts(facts.snaps, facts.stats, players.limit(0))
        rows = opportunity.join_tracking(opportunity.snap_changes(facts.snaps).join(facts.stats, on=[*opportunity.HISTORY, *opportunity.HISTORY_ORDER], how="left"), list(facts.tracking), "player_key")
        for df in (rows, opportunity.snap_changes(facts.snaps)):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", scored._jdf.queryExecution().executedPlan().toString())
        assert not any("season" in keys for keys in moved)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_command_line(spark, landed, tmp_path):
    assert main(["facts", "all", "-i", landed, "-o", f"{tmp_path}/facts"]) == 0
    for out, more in (("plain", []), ("bucketed", ["--facts", f"{tmp_path}/facts"])):
        assert main(["opportunity", "2021", "-i", landed, "-o", f"{tmp_path}/{out}", "--format", "parquet", *more]) == 0
    plain, bucketed = (spark.read.parquet(f"{tmp_path}/{out}/opportunity_report") for out in ("plain", "bucketed"))
    assert plain.exceptAll(bucketed).isEmpty() and bucketed.exceptAll(plain).isEmpty() and not plain.isEmpty()


def test_one_file_a_bucket_and_a_layout_for_other_sessions(spark, tmp_path):
    df = spark.range(1000).selectExpr("concat('p', id % 50) AS player_key", "int(2020 + id % 3) AS season", "id AS `odd name`")
    write_bucketed(df, str(tmp_path), "numbers", 4)
    assert len(list((tmp_path / "numbers").glob("part-*.parquet"))) == 4
    other = read_bucketed(spark.newSession(), str(tmp_path), "numbers")
    assert other.count() == 1000 and other.dtypes == df.dtypes
    counted = other.groupBy("player_key", "season").count()
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString() and counted.count() == 150
    assert buckets_for(10) == 8 and buckets_for(10**9) == 500


def test_every_core_has_buckets(spark, inputs, tmp_path):
    Facts.land(str(tmp_path), *inputs[0])
    buckets = {json.loads(p.read_text())["buckets"] for p in tmp_path.glob("*/_layout.json")}
    assert len(buckets) == 1 and buckets.pop() >= 3 * spark.sparkContext.defaultParallelism
