import math
from functools import reduce

import pytest
from pyspark.sql import functions as F

from tallyweek.checks import assert_unique, duplicate_keys
from tallyweek.plans import matrix, opportunity, quarterback, receiving, rushing, snap_share, team_games

PLAYS = (
    "game_id string, season int, week int, home_team string, away_team string, posteam string, play_type string, "
    "passer_player_id string, receiver_player_id string, rusher_player_id string, pass_attempt double, "
    "complete_pass double, pass_touchdown double, interception double, first_down_pass double, sack double, "
    "qb_scramble double, qb_hit double, rush_attempt double, rush_touchdown double, first_down_rush double, "
    "yards_gained double, rushing_yards double, air_yards double, yards_after_catch double, qb_epa double, "
    "cpoe double, two_point_conv_result string"
)
ROLE_KEYS = ["game_id", "season", "week", "gsis_id", "team"]


def play(**values):
    base = dict(game_id="2024_1_A_B", season=2024, week=1, home_team="B", away_team="A", posteam="A", pass_attempt=0.0)
    return {**base, **values}


def as_set(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_role_statistics_match_three_outer_joins(frame, league):
    dirty = frame(PLAYS, [
        play(passer_player_id="q", receiver_player_id="w", pass_attempt=1.0, complete_pass=1.0, yards_gained=7.0),
        play(passer_player_id="q", pass_attempt=1.0, two_point_conv_result="success"),
        play(rusher_player_id="q", rush_attempt=1.0, yards_gained=3.0),
        play(passer_player_id="q", receiver_player_id="q", pass_attempt=1.0, posteam=None),
        play(game_id=None, passer_player_id="q", receiver_player_id="q", pass_attempt=1.0),
    ])
    for plays in (dirty, league["plays"]):
        roles = [opportunity.passing_by_game(plays), opportunity.receiving_by_game(plays), opportunity.rushing_by_game(plays)]
        joined = reduce(lambda a, b: a.join(b, ROLE_KEYS, "full"), roles)
        joined = joined.join(team_games.team_targets(plays), ["game_id", "team"], "left")
        single = opportunity.player_game_stats(plays)
        columns = [c for c in single.columns if c != "target_share"]
        assert as_set(single, columns) == as_set(joined, columns)
    stats = {(r.gsis_id, r.team, r.game_id): r for r in opportunity.player_game_stats(dirty).where("pass_attempts > 0").collect()}
    row = stats[("q", "A", "2024_1_A_B")]
    assert (row.pass_attempts, row.pass_2pt_conversions, row.rush_attempts, row.receptions, row.targets) == (2.0, 1, 1.0, None, None)


def test_passer_rating(frame):
    df = frame("attempts double, completions double, passing_yards double, passing_tds double, interceptions double", [
        dict(attempts=20.0, completions=16.0, passing_yards=260.0, passing_tds=3.0, interceptions=0.0),
        dict(attempts=10.0, completions=None, passing_yards=50.0, passing_tds=0.0, interceptions=0.0),
        dict(attempts=10.0, completions=1.0, passing_yards=0.0, passing_tds=0.0, interceptions=5.0),
    ])
    got = [r[0] for r in df.select(quarterback.passer_rating()).collect()]
    assert math.isclose(got[0], 158.33333333333334) and got[1] is None and got[2] == 0.0


def test_quarterbacks_without_plays_or_opponents(league):
    stats = league["player_stats"].drop("opponent_team").withColumnRenamed("player_display_name", "player_name")
    report = quarterback.qb_report(stats)
    assert report.columns == quarterback.REPORT_COLUMNS
    row = report.first()
    assert (row.game_id, row.opponent) == ("", "") and all(row[m] is None for m in quarterback.PLAY_METRICS)
    assert report.count() == quarterback.qb_report(league["player_stats"], league["plays"]).count()


def test_receiving_without_opponents(league):
    stats = league["player_stats"].drop("opponent_team")
    report = receiving.receiving_report(stats, league["team_stats"], league["plays"])
    assert report.columns == receiving.REPORT_COLUMNS and {r[0] for r in report.select("opponent").distinct().collect()} == {""}


def test_unmapped_players_keep_their_own_history(frame):
    snaps = frame(
        "game_id string, season int, week int, player string, pfr_player_id string, position string, team string, "
        "opponent string, offense_snaps double, offense_pct double, defense_snaps double, defense_pct double, "
        "st_snaps double, st_pct double",
        [
            dict(game_id=f"g{w}", season=2024, week=w, player=p, pfr_player_id=i, team="A", offense_pct=v)
            for w, p, i, v in [(1, "x", "f1", 0.5), (2, "x", "f1", 0.75), (1, "y", None, 0.1), (2, "y", None, 0.2), (2, "z", "f9", 1.0)]
        ],
    )
    players = frame("gsis_id string, pfr_id string", [{"gsis_id": "g", "pfr_id": "other"}])
    rows = opportunity.snap_with_ids(snaps, players).where("week = 2").collect()
    got = sorted((round(r.offense_snap_share, 2), r.wow_offense_snap_share_change) for r in rows)
    assert [v for v, _ in got] == [0.2, 0.75, 1.0]
    assert math.isclose(got[0][1], 0.1) and got[1][1] == 0.25 and got[2][1] is None


def test_opportunity_without_optional_sources(spark, league):
    from tallyweek.operators.schema import optional
    from tallyweek.sources.schemas import LANDED

    names = ("plays", "tracking_passing", "tracking_receiving", "tracking_rushing", "combine")
    empty = [optional(None, LANDED[n], spark) for n in names]
    report = opportunity.opportunity_report(league["snap_counts"], league["players"], *empty)
    assert report.columns == opportunity.REPORT_COLUMNS and len(report.columns) == 76
    assert report.dtypes == spark.createDataFrame([], opportunity.REPORT_SCHEMA).dtypes
    assert report.count() == league["snap_counts"].count()
    assert {tuple(r) for r in report.select("fantasy_points", "targets", "bench").distinct().collect()} == {(0.0, None, None)}


def opportunity_of(league):
    names = ("snap_counts", "players", "plays", "tracking_passing", "tracking_receiving", "tracking_rushing", "combine")
    return opportunity.opportunity_report(*[league[n] for n in names])


def test_opportunity_invariants(league):
    report = opportunity_of(league).cache()
    assert_unique(report)
    assert duplicate_keys(snap_share.snap_share_report(league["snap_counts"]), ["season", "week", "team", "pfr_player_id"]).count() > 0
    bad = report.where(~F.col("offense_snap_share").between(0, 1) | ~F.col("target_share").between(0, 1))
    assert bad.count() == 0
    scored = opportunity.scored_rows(league["snap_counts"], league["players"], league["plays"], opponents=False)
    ranks = opportunity.position_rank(scored.withColumn("offense_snaps", F.lit(1.0)))
    holes = (
        ranks.groupBy("season", "week", "position")
        .agg(F.max("f_position_rank").alias("top"), F.countDistinct("f_position_rank").alias("n"))
        .where("top <> n")
    )
    assert holes.count() == 0
    report.unpersist()


def test_quarterback_shares_add_up(league):
    report = quarterback.qb_report(league["player_stats"], league["plays"])
    totals = report.groupBy("season", "week", "team").agg(F.sum("team_pass_attempt_share").alias("s"))
    assert totals.where("s > 1.000001").count() == 0


REPORT = (
    "season int, week int, team string, position string, player_name string, offense_snap_share double, targets double, "
    "percent_share_of_intended_air_yards double, avg_yac double, rush_first_downs double, receiving_first_downs double, "
    "completion_percentage double"
)


def weekly(week, name, team, position, share, **values):
    return dict(season=2024, week=week, player_name=name, team=team, position=position, offense_snap_share=share, **values)


def test_one_name_on_two_teams_merges(frame):
    rows = [weekly(w, "Same", "B", "WR", 0.5, targets=float(w)) for w in (1, 2)]
    rows += [weekly(w, "Same", "A", "RB", 0.9, targets=10.0 + w) for w in (2, 3)]
    rows += [weekly(w, "Quarter", "A", "QB", 1.0, completion_percentage=70.0) for w in (1, 2, 3)]
    rows += [weekly(1, "Rare", "A", "QB", 1.0), weekly(1, "Kick", "A", "K", 1.0)]
    regulars = matrix.skill_regulars(frame(REPORT, rows))
    places = matrix.player_order(regulars)
    order = {r.player_name: r for r in places.collect()}
    assert set(order) == {"Same", "Quarter"}
    assert (order["Same"].team, order["Same"].position) == ("B", "WR")
    assert (order["Quarter"].expanded_index, order["Same"].expanded_index) == (0, 2)
    cells = matrix.metric_rows(regulars, places).where("player_name = 'Same' AND metric = 'targets'")
    assert sorted((r.week, r.value, r.row_label, r.row_index) for r in cells.collect()) == [
        (1, 1.0, "  → Targets", 3),
        (2, 12.0, "  → Targets", 3),
        (3, 13.0, "  → Targets", 3),
    ]
    lines = sorted((r.line_at, r.kind, r.team_label) for r in matrix.group_boundaries(places).collect())
    assert lines == [(1.5, "team", "A"), (5.5, "end", "B")]


def test_scale_defaults_without_positive_maximum(frame):
    rows = [weekly(w, "R", "A", "RB", 0.5, targets=0.0, rush_first_downs=float(w)) for w in (1, 2, 4)]
    cells = matrix.Matrix(frame(REPORT, rows)).cell_intensity()
    got = {(r.metric, r.week): (r.scale_maximum, r.intensity) for r in cells.collect()}
    assert got[("targets", 1)] == (15.0, 0.0)
    assert got[("rush_first_downs", 1)] == (4.0, 0.25)
    assert got[("receiving_first_downs", 1)] == (5.0, None)
    assert got[("offense_snap_share", 1)] == (None, 0.5)


def test_rushing_division_by_zero_is_null(frame):
    plays = frame(PLAYS, [play(play_type="run", rusher_player_id="r", rushing_yards=5.0, rush_attempt=None)])
    players = frame("gsis_id string, display_name string, position string", [dict(gsis_id="r", display_name="R", position="RB")])
    row = rushing.rushing_leaders(plays, players).first()
    assert (row.rank, row.name, row.rush_attempt, row.ypa) == (1, "R", 0, None)


@pytest.mark.parametrize("name", ["snap", "opportunity"])
def test_grid_and_change_invariants(league, name):
    snaps = league["snap_counts"]
    if name == "snap":
        report = snap_share.snap_share_report(snaps)
        key = ["season", "pfr_player_id", "team"]
        change, week = "wow_offense_snap_share_change", "week"
        first = report.groupBy(*key).agg(F.count(F.when(F.col(change).isNull(), 1)).alias("n"), F.min(week))
        assert first.where("n <> 1").count() == 0
    else:
        assert opportunity_of(league).where("opponent = ''").count() == 0


def test_derived_tables_use_every_row(spark, league):
    from tests.conftest import TESTDATA

    raw = {t: spark.read.parquet(f"{TESTDATA}/{t}.parquet") for t in ("orders", "customer", "lineitem")}
    assert league["plays"].count() == raw["lineitem"].count()
    assert league["players"].count() == league["combine"].count() == raw["customer"].count()
    places = raw["orders"].selectExpr("2020 + o_orderkey % 3 AS season", "cast((o_custkey - o_custkey % 8)/8 AS int) + 1 AS p", "o_orderkey")
    per_player = places.groupBy("season", "p").agg(F.sum("o_orderkey").alias("s"))
    weeks = league["snap_counts"].groupBy("season", "pfr_player_id").agg(F.count("*").alias("weeks"), F.max("week"), F.min("week"))
    assert weeks.count() == per_player.count() and weeks.where("`max(week)` > 18 OR `min(week)` < 1").count() == 0
    assert league["snap_counts"].where("season = 2021 AND week = 9").count() == 0
    tracked = league["plays"].where("passer_player_id IS NOT NULL").select("season", "week", "passer_player_id").distinct()
    assert league["tracking_passing"].count() == tracked.count()


def test_regulars_come_from_every_season(league):
    report = snap_share.snap_share_report(league["snap_counts"])
    assert {r.season for r in snap_share.regular_players(report).collect()} == {2020, 2021, 2022}
    progression = snap_share.top_regular_progression(report)
    assert progression.groupBy("season").agg(F.countDistinct("player", "team").alias("n")).where("n <> 1").count() == 0
    assert progression.select("season").distinct().count() == 3


def test_no_rank_is_lost_with_fractional_yards(league):
    plays = league["plays"].withColumn("yards_gained", F.col("yards_gained") + F.rand(3) / 7)
    names = ("snap_counts", "players", "tracking_passing", "tracking_receiving", "tracking_rushing", "combine")
    snaps, players, *more = [league[n] for n in names]
    report = opportunity.opportunity_report(snaps, players, plays, *more)
    assert report.where("offense_snaps >= 1 AND f_position_rank IS NULL").count() == 0


def test_missing_names_are_filled(frame):
    rows = [snap_row(w, p) for w, p in ((1, "x"), (2, None), (4, "x"))]
    got = sorted(tuple(r) for r in snap_share.snap_share_report(frame(SNAPS, rows)).select("week", "player").collect())
    assert got == [(1, "x"), (2, "x"), (2, "x"), (4, "x")]


SNAPS = (
    "game_id string, season int, week int, player string, pfr_player_id string, position string, team string, opponent string, "
    "offense_snaps double, offense_pct double, defense_snaps double, defense_pct double, st_snaps double, st_pct double"
)


def snap_row(week, player):
    return dict(season=2024, week=week, player=player, pfr_player_id="f", position="QB", team="A", offense_pct=0.5)
