"""Weighted sums of statistics."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def weighted_score(weights: Mapping[str, float]) -> Column:
    """Sum of column times weight in the order given; NULL counts as 0."""
    terms = [F.coalesce(F.col(name), F.lit(0)) * F.lit(float(points)) for name, points in weights.items()]
    return reduce(lambda total, term: total + term, terms)
