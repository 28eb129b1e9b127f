"""Derived measures as plain column expressions; all of them stay inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The order in which skill positions are listed; anything else comes last.
POSITION_ORDER = {"QB": 0, "RB": 1, "WR": 2, "TE": 3}
OTHER_POSITION_ORDER = 99


def safe_div(numerator: str | Column, denominator: str | Column) -> Column:
    """numerator / denominator where the denominator is above zero, else NULL."""
    n = F.col(numerator) if isinstance(numerator, str) else numerator
    d = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.when(d > 0, n.cast("double") / d)


def clip(value: Column, low: float, high: float) -> Column:
    """Clamp to [low, high]; NULL stays NULL (greatest/least alone would skip it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def is_blank(value: Column) -> Column:
    return value.isNull() | (value == "")


def fallback_blank(value: Column, fallback: Column) -> Column:
    """The value, or the fallback where the value is NULL or the empty string."""
    return F.when(is_blank(value), fallback).otherwise(value)


def person_key(name: Column, *ids: tuple[str, Column]) -> Column:
    """A person's first known id, else the name, each marked by its kind; the first id is bare.

    As a join and window key it keeps people without an id apart, where NULL would pool them in
    one partition and one history.
    """
    (_, first), *others = ids
    return F.coalesce(first, *[F.concat(F.lit(kind + ":"), c) for kind, c in others], F.concat(F.lit("name:"), name))


def position_order(position: Column) -> Column:
    order = F.lit(OTHER_POSITION_ORDER)
    for name, place in POSITION_ORDER.items():
        order = F.when(position == name, F.lit(place)).otherwise(order)
    return order


def week_of_game(game_id: Column) -> Column:
    """Week number inside a ``season_week_away_home`` game id."""
    return F.split(game_id, "_")[1].cast("int")


def one_decimal_text(value: Column) -> Column:
    """Text with one decimal, rounded on the exact binary value, exact halves to even.

    The JVM formatter rounds the shortest decimal spelling, so 0.15 (binary slightly below)
    would print 0.2. A value is a candidate tie when 20 times it is an odd integer; splitting it
    into a 24-bit head and the rest makes the distance to the tie exact, and its sign decides.
    """
    scaled = value * 20
    odd = (scaled == F.floor(scaled)) & (F.abs(F.pmod(scaled, F.lit(2.0))) == 1)
    head = value.cast("float").cast("double")
    distance = (head * 20 - scaled) + (value - head) * 20
    low, high = (scaled - 1) / 20, (scaled + 1) / 20
    rounded = (
        F.when(odd & (distance > 0), F.bround(high, 1))
        .when(odd & (distance < 0), F.bround(low, 1))
        .otherwise(F.bround(value, 1))
    )
    return F.format_string("%.1f", rounded)


def whole_text(value: Column) -> Column:
    """Text of the integer part."""
    return value.cast("bigint").cast("string")


def percent_text(value: Column) -> Column:
    """Whole percent with exact halves to even; the value is already on the 0-100 scale."""
    return F.concat(F.bround(value, 0).cast("bigint").cast("string"), F.lit("%"))
