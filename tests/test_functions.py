import random

from pyspark.sql import functions as F

from tallyweek.functions.aggregates import avg_where, count_where, sum_or_zero, sum_where
from tallyweek.functions.scalars import (
    clip,
    fallback_blank,
    one_decimal_text,
    percent_text,
    position_order,
    safe_div,
    week_of_game,
    whole_text,
)


def test_empty_sums_are_zero_and_averages_null(frame):
    df = frame("k int, x double, f int", [{"k": 1, "x": 2.0, "f": 0}, {"k": 2, "x": None, "f": 1}])
    out = df.groupBy("k").agg(
        sum_where("x", F.col("f") == 1).alias("s"),
        sum_or_zero("x").alias("all"),
        count_where(F.col("f") == 1).alias("n"),
        avg_where("x", F.col("f") == 1).alias("a"),
    )
    assert sorted(map(tuple, out.collect())) == [(1, 0.0, 2.0, 0, None), (2, 0.0, 0.0, 1, None)]


def test_clip_keeps_null(frame):
    df = frame("x double", [{"x": None}, {"x": -1.0}, {"x": 9.0}, {"x": 1.5}])
    assert [r[0] for r in df.select(clip(F.col("x"), 0.0, 2.375)).collect()] == [None, 0.0, 2.375, 1.5]


def test_division_is_guarded(frame):
    df = frame("n double, d double", [{"n": 1.0, "d": 0.0}, {"n": 1.0, "d": 4.0}, {"n": 1.0, "d": None}])
    assert [r[0] for r in df.select(safe_div("n", "d")).collect()] == [None, 0.25, None]


def test_text_rounding_follows_the_binary_value(spark):
    rng = random.Random(7)
    values = [i / 20 for i in range(-400, 1200)] + [i / 8 for i in range(400)] + [rng.uniform(0, 99) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", one_decimal_text(F.col("v")).alias("t"), percent_text(F.col("v")).alias("p")).collect()
    wrong = [(r.v, r.t) for r in rows if float(r.t) != float(f"{r.v:.1f}") or len(r.t.lstrip("-")) != len(f"{abs(r.v):.1f}")]
    assert wrong == []
    assert [r.v for r in rows if r.v >= 0 and r.p != f"{r.v:.0f}%"] == []


def test_small_scalars(frame):
    df = frame(
        "p string, g string, o string, v double",
        [{"p": "TE", "g": "2024_07_A_B", "o": "", "v": 7.9}, {"p": "K", "g": "2024_1_A_B", "o": "X", "v": 3.0}],
    )
    rows = df.select(
        position_order(F.col("p")),
        week_of_game(F.col("g")),
        fallback_blank(F.col("o"), F.lit("Y")),
        whole_text(F.col("v")),
    ).collect()
    assert list(map(tuple, rows)) == [(3, 7, "Y", "7"), (99, 1, "X", "3")]
