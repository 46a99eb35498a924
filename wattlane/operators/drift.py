"""Reference statistics and drift against them.

One wide aggregate (count, mean, population std, min, max per column) is
unpivoted to one row per column with ``stack``; comparison is an inner join
on the column name (both sides have one row per column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from wattlane.operators.validate import coerce_numeric


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (NumericType, BooleanType))]


def compute_reference_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, count, mean, std, min, max); all-null columns are skipped."""

    cols = list(columns or numeric_columns(df))
    aggs = []
    for i, c in enumerate(cols):
        x = coerce_numeric(df, c)
        x = F.when(~F.isnan(x), x)
        aggs += [
            F.count(x).cast("double").alias(f"c{i}"), F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}"),
            F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
        ]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{c}', c{i}, m{i}, s{i}, lo{i}, hi{i}" for i, c in enumerate(cols))
    long = wide.selectExpr(f"stack({len(cols)}, {parts}) AS (column, count, mean, std, min, max)")
    return long.where(F.col("count") > 0)


def compare_to_reference_stats(
    current: DataFrame, reference: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """Means, delta, delta / reference std (NULL when that std is not positive), both stds."""

    cur = compute_reference_stats(current, columns).select(
        "column", F.col("mean").alias("current_mean"), F.col("std").alias("current_std")
    )
    ref = reference.select(
        "column", F.col("mean").alias("reference_mean"), F.coalesce(F.col("std"), F.lit(0.0)).alias("reference_std")
    )
    delta = F.col("current_mean") - F.col("reference_mean")
    return cur.join(F.broadcast(ref), "column").select(
        "column", "current_mean", "reference_mean", delta.alias("mean_delta"),
        F.when(F.col("reference_std") > 0, delta / F.col("reference_std")).alias("normalized_mean_delta"),
        "current_std", "reference_std",
    )
