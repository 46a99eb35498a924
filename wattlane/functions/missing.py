"""NaN is missing, as NULL is: the one place that says so."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def known(c: str | Column) -> Column:
    """A number as a double, NULL where it is NULL or NaN."""

    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(x), x)


def finite(c: str | Column) -> Column:
    """A number as a double, NULL where it is NULL, NaN or infinite."""

    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)
