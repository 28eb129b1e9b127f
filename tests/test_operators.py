import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyweek.operators.change import change
from tallyweek.operators.entities import bridge_id, min_appearances, two_sided
from tallyweek.operators.ranking import places_in_order, rows_before, with_dense_rank
from tallyweek.operators.reshape import first_cells, periods_of, pivot_period
from tallyweek.operators.schema import first_available, optional, select_available
from tallyweek.plans.snap_share import snap_grid, snap_share_report

SNAPS = (
    "season int, week int, player string, pfr_player_id string, position string, team string, opponent string, "
    "offense_snaps double, offense_pct double, defense_snaps double, defense_pct double, st_snaps double, st_pct double"
)


def snap(week, pct, pid="p1", player="One", team="A", season=2024, position="QB", opponent="Z"):
    return dict(
        season=season, week=week, player=player, pfr_player_id=pid, position=position, team=team, opponent=opponent,
        offense_snaps=pct * 64, offense_pct=pct, defense_snaps=0.0, defense_pct=0.0, st_snaps=0.0, st_pct=0.0,
    )


def shares(df):
    return [
        (r.team, r.week, r.opponent, r.offense_snap_share, r.wow_offense_snap_share_change)
        for r in df.orderBy("season", "pfr_player_id", "team", "week", "player").collect()
    ]


def test_gap_weeks_are_filled_with_zeros(frame):
    rows = [snap(1, 0.5), snap(2, 0.75), snap(4, 0.25), snap(3, 1.0, pid="p2", player="Two", team="B")]
    report = snap_share_report(frame(SNAPS, rows)).where("pfr_player_id = 'p1'")
    assert shares(report) == [
        ("A", 1, "Z", 0.5, None),
        ("A", 2, "Z", 0.75, 0.25),
        ("A", 3, "", 0.0, -0.75),
        ("A", 4, "Z", 0.25, 0.25),
    ]


def test_change_restarts_with_a_new_team(frame):
    rows = [snap(1, 0.5), snap(2, 1.0), snap(4, 0.25, team="B"), snap(5, 0.5, team="B"), snap(3, 1.0, pid="p2", team="B")]
    report = snap_share_report(frame(SNAPS, rows)).where("pfr_player_id = 'p1'")
    assert shares(report) == [
        ("A", 1, "Z", 0.5, None),
        ("A", 2, "Z", 1.0, 0.5),
        ("B", 4, "Z", 0.25, None),
        ("B", 5, "Z", 0.5, 0.25),
    ]


def test_a_week_nobody_plays_has_no_rows(frame):
    rows = [snap(w, 0.5) for w in (1, 2, 4)] + [snap(3, 0.5, season=2023)]
    weeks = [r.week for r in snap_grid(frame(SNAPS, rows)).where("season = 2024").orderBy("week").collect()]
    assert weeks == [1, 2, 4]


def test_two_spellings_double_the_rows(frame):
    rows = [snap(1, 0.5), snap(2, 0.75, player="One Jr."), snap(3, 1.0)]
    report = snap_share_report(frame(SNAPS, rows))
    got = [(r.week, r.player, r.wow_offense_snap_share_change) for r in report.orderBy("week", "player").collect()]
    assert got == [(1, "One", None), (2, "One", 0.25), (2, "One Jr.", 0.0), (3, "One", 0.25)]


def test_change_follows_rows_not_weeks(frame):
    df = frame("k string, w int, x double", [{"k": "a", "w": 1, "x": 1.0}, {"k": "a", "w": 5, "x": 4.0}])
    assert [r.d for r in change(df, ["k"], ["w"], {"x": "d"}).orderBy("w").collect()] == [None, 3.0]


@pytest.mark.parametrize("hot", [False, True])
def test_dense_rank_matches_brute_force(spark, hot):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        group = "hot" if hot and i % 3 == 0 else rng.choice(["a", "b", None])
        value = None if i % 50 == 0 else (0.0 if hot and i % 3 == 0 else rng.choice([-2.5, 0.0, 0.25, 7.1, rng.uniform(-5, 40)]))
        rows.append((i, group, value))
    df = spark.createDataFrame(rows, "i int, g string, v double")
    got = {r.i: r.rank for r in with_dense_rank(df, ["g"], "v", "rank").collect()}
    for _, group, _ in rows[:3]:
        values = sorted({v for _, g, v in rows if g == group and v is not None}, reverse=True)
        for i, g, v in rows:
            if g == group:
                assert got[i] == (None if v is None else values.index(v) + 1)
    assert len(got) == len(rows)


def test_hidden_rows_still_occupy_a_rank(frame):
    df = frame("g int, v double, snaps double", [
        {"g": 1, "v": 30.0, "snaps": 0.0}, {"g": 1, "v": 20.0, "snaps": 5.0}, {"g": 1, "v": 10.0, "snaps": 5.0},
    ])
    ranked = with_dense_rank(df, ["g"], "v", "r", shown=F.col("snaps") >= 1)
    assert sorted((r.v, r.r) for r in ranked.collect()) == [(10.0, 3), (20.0, 2), (30.0, None)]


def test_places_in_order_match_brute_force(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice([None, 1, 2]), rnd.choice("abc"), i, rnd.randint(1, 4)) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, a string, b int, w int").repartition(5)
    placed = places_in_order(df, ["g"], [F.asc("a"), F.desc("b")], {"n": F.lit(1), "s": F.col("w")}, "places")
    assert placed.columns == ["g", "a", "b", "w", "n", "s"]
    for r in placed.collect():
        before = [x for x in rows if x[0] == r.g and (x[1], -x[2]) < (r.a, -r.b)]
        assert (r.n, r.s) == (len(before), sum(x[3] for x in before))


def test_rows_without_an_id_are_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        snaps = spark.range(4000).selectExpr("IF(id % 2 = 0, NULL, concat('p', id)) AS s", "concat('n', id) AS name")
        players = spark.createDataFrame([("p1", 1), (None, 2)], "f string, g int")
        joined = bridge_id(snaps, players, "s", "f", apart=["name"])
        assert joined.columns == ["s", "name", "g"] and joined.count() == 4000
        assert [r.name for r in joined.where("g IS NOT NULL").collect()] == ["n1"]
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "xxhash64" in plan.split("Exchange hashpartitioning")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_before_matches_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([1, 2]), rng.choice(["x", "y", None]), rng.randint(0, 3), rng.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "i int, season int, team string, pos int, v double")
    out = rows_before(
        df,
        ["season"],
        [("team", F.col("team")), ("pos", F.col("pos")), ("b", -F.floor(F.col("v") * 10))],
        [F.desc("v"), F.asc("i")],
        {"n": F.lit(1), "wide": F.col("pos") + 1},
    )
    assert out.columns == [*df.columns, "n", "wide"]
    got = {r.i: (r.n, r.wide) for r in out.collect()}
    for season in (1, 2):
        ordered = sorted((r for r in rows if r[1] == season), key=lambda r: (r[2] is not None, r[2] or "", r[3], -r[4], r[0]))
        wide = 0
        for n, row in enumerate(ordered):
            assert got[row[0]] == (n, wide)
            wide += row[3] + 1


def test_bridge_fans_out_on_duplicate_ids(frame):
    snaps = frame("s string", [{"s": "f1"}, {"s": "f2"}, {"s": None}])
    players = frame("g string, f string", [{"g": "g1", "f": "f1"}, {"g": "g2", "f": "f1"}, {"g": "g3", "f": None}])
    got = sorted(((r.s, r.g) for r in bridge_id(snaps, players, "s", "f").collect()), key=str)
    assert got == [("f1", "g1"), ("f1", "g2"), ("f2", None), (None, None)]


def test_sides_and_appearances(frame):
    games = frame("id int, h string, a string", [{"id": 1, "h": "H", "a": "A"}])
    assert sorted(map(tuple, two_sided(games, ["id"], "h", "a", "team", "opp").collect())) == [(1, "A", "H"), (1, "H", "A")]
    df = frame("n string, w int", [{"n": "a", "w": 1}, {"n": "a", "w": 2}, {"n": "b", "w": 1}, {"n": "a", "w": None}])
    assert sorted({r.n for r in min_appearances(df, ["n"], "w", 2).collect()}) == ["a"]
    assert min_appearances(df, ["n"], "w", 3).count() == 0


def test_first_cell_and_pivot(frame):
    df = frame("r string, w int, t string, v double", [
        {"r": "a", "w": 1, "t": "T2", "v": 2.0}, {"r": "a", "w": 1, "t": "T1", "v": None}, {"r": "a", "w": 3, "t": "T2", "v": 5.0},
    ])
    cells = first_cells(df, ["r", "w"], ["t"], ["v"])
    assert sorted(map(tuple, cells.collect())) == [("a", 1, None), ("a", 3, 5.0)]
    assert periods_of(df, "w") == [1, 3]
    wide = pivot_period(cells, ["r"], "w", [1, 2, 3], "v")
    assert wide.columns == ["r", "week_1", "week_2", "week_3"]
    assert [tuple(r) for r in wide.collect()] == [("a", None, None, 5.0)]


def test_schema_adaptation(spark, frame):
    df = frame("a int, b string", [{"a": 1, "b": "x"}])
    assert select_available(df, ["b", "c"]).columns == ["b"]
    assert df.select(first_available(df, ["z", "a"]).alias("v")).first().v == 1
    assert df.select(first_available(df, ["z"], F.lit("")).alias("v")).first().v == ""
    with pytest.raises(ValueError):
        first_available(df, ["y", "z"])
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("c", T.DoubleType())])
    assert optional(None, schema, spark).schema == schema
    assert [tuple(r) for r in optional(df, schema).collect()] == [(1, None)]


def test_people_without_an_id_keep_their_own_history(frame):
    rows = [snap(1, 0.5, pid=None, player=p) for p in ("x", "y")] + [snap(2, 0.5, pid=None, player=p) for p in ("x", "y")]
    report = snap_share_report(frame(SNAPS, rows))
    got = sorted((r.player, r.week, r.offense_snap_share, r.wow_offense_snap_share_change) for r in report.collect())
    # people without an id are matched by name
    assert got == [("x", 1, 0.5, None), ("x", 2, 0.5, 0.0), ("y", 1, 0.5, None), ("y", 2, 0.5, 0.0)]


def test_session_settings(spark):
    from tallyweek.session import INITIAL_PARTITIONS, SETTINGS

    assert all(spark.conf.get(key) == value for key, value in SETTINGS.items())
    assert spark.conf.get(INITIAL_PARTITIONS) == "24"
