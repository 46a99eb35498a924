"""Mergeable moments: (n, mean, m2), m2 being the sum of squared deviations from the mean.

Two sets of rows merge without subtracting one sum from another (Chan, Golub
and LeVeque), so the digits of small deviations survive large values nearby.
"""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def running(x: Column, over: WindowSpec) -> Column:
    """The moments of the known values of a running frame; constant time a row."""

    n = F.count(x).over(over)
    return F.struct(n.alias("n"), F.avg(x).over(over).alias("mean"), (F.var_pop(x).over(over) * n).alias("m2"))


def merged(a: Column, b: Column) -> Column:
    """The moments of two disjoint sets of rows; a NULL or empty one adds nothing."""

    none_a, none_b = F.coalesce(a["n"], F.lit(0)) == 0, F.coalesce(b["n"], F.lit(0)) == 0
    n = a["n"] + b["n"]
    gap, share = b["mean"] - a["mean"], b["n"] / n
    both = F.struct(n.alias("n"), (a["mean"] + gap * share).alias("mean"),
                    (a["m2"] + b["m2"] + gap * gap * a["n"] * share).alias("m2"))
    return F.when(none_a, b).when(none_b, a).otherwise(both)


def sample_std(moments: Column) -> Column:
    """Sample standard deviation; NULL for less than two values."""

    return F.when(moments["n"] > 1, F.sqrt(moments["m2"] / (moments["n"] - 1)))
