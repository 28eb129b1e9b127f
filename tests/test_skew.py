"""A third of all rows on one key: results stay whole and no task sorts a whole group."""

import pytest
from pyspark.sql import functions as F

from tallyweek.operators.ranking import with_dense_rank
from tallyweek.plans import opportunity, team_games

SPLITTING = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
}


@pytest.fixture
def splitting(spark):
    for key, value in SPLITTING.items():
        spark.conf.set(key, value)
    yield
    for key in SPLITTING:
        spark.conf.unset(key)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_rank_of_a_hot_group(spark, splitting):
    rows = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100).cast("int").alias("g"),
        F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise((F.col("id") % 997) / 8).alias("v"),
    )
    ranked = with_dense_rank(rows, ["g"], "v", "r", block_width=1.0)
    assert ranked.count() == 60000
    top = ranked.groupBy("g").agg(F.max("r").alias("top"), F.countDistinct("v").alias("n"))
    assert top.where("top <> n").count() == 0
    plan = final_plan(ranked)
    # each group is sorted per block, and only block sizes per group
    assert "windowspecdefinition(g" in plan and "__block" in plan
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_unmapped_players_do_not_share_a_key(league):
    snaps = league["snap_counts"].withColumn(
        "pfr_player_id", F.when(F.col("week") % 3 == 0, F.concat(F.lit("new"), "pfr_player_id")).otherwise(F.col("pfr_player_id"))
    )
    keyed = opportunity.with_player_ids(snaps, league["players"])
    unmapped = keyed.where("gsis_id IS NULL")
    assert unmapped.count() * 4 > keyed.count()
    assert keyed.where("player_key IS NULL").count() == 0
    per_key = unmapped.groupBy("player_key").count().agg(F.max("count")).first()[0]
    assert per_key <= 18 * 3


def test_one_game_with_a_third_of_the_plays(spark, league, splitting):
    plays = league["plays"]
    hot = plays.where("game_id = '2020_1_T0_T1'")
    times = plays.count() // (2 * hot.count())
    copies = hot.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("copy")
    both = plays.where("game_id <> '2020_1_T0_T1'").unionByName(copies)
    stats = opportunity.player_game_stats(both)
    totals = stats.groupBy("game_id", "team").agg(F.sum("targets").alias("t"), F.max("team_targets").alias("team_targets"))
    expected = team_games.team_targets(both)
    joined = totals.where("t IS NOT NULL").join(expected.withColumnRenamed("team_targets", "e"), ["game_id", "team"])
    assert joined.count() == expected.count() and joined.where("t <> e OR team_targets <> e").count() == 0
