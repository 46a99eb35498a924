"""Forecast and classification metrics as one aggregate each.

Undefined values (MAPE with no non-zero actuals, R2 with fewer than two
rows) are NULL, which is what the JSON writers emit for NaN anyway.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.schema import MAPE_EPS


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def forecast_metric_columns(actual: str | Column, predicted: str | Column) -> list[Column]:
    y, p = _c(actual).cast("double"), _c(predicted).cast("double")
    e = y - p
    n = F.count(F.lit(1))
    sse = F.sum(e * e)
    sst = F.var_pop(y) * n
    r2 = (
        F.when(n < 2, F.lit(None).cast("double"))
        .when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(1 - sse / sst)
    )
    return [
        n.alias("rows"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.when(F.abs(y) > MAPE_EPS, F.abs(e / y))) * 100.0).alias("mape"),
        r2.alias("r2"),
    ]


def forecast_metrics(
    df: DataFrame, actual: str | Column, predicted: str | Column, *, by: Sequence[str] = ()
) -> DataFrame:
    """A1-A3: rows, MAE, RMSE, MAPE (percent), R2 per group."""

    cols = forecast_metric_columns(actual, predicted)
    if by:
        return df.groupBy(*by).agg(*cols)
    return df.agg(*cols).withColumn("rows", _not_empty(F.col("rows")))


def _not_empty(rows: Column) -> Column:
    """The row count itself; evaluating it fails when there are no rows."""

    error = F.raise_error(F.lit("actual and predicted values must not be empty."))
    return F.when(rows == 0, error.cast("long")).otherwise(rows)


def confusion_columns(label: str | Column, prediction: str | Column) -> list[Column]:
    """Counts by label and flag; an unknown label or flag (NULL) counts as negative."""

    no = F.lit(False)
    lab, pred = F.coalesce(_c(label).cast("boolean"), no), F.coalesce(_c(prediction).cast("boolean"), no)
    return [
        F.count_if(~lab & ~pred).alias("tn"),
        F.count_if(~lab & pred).alias("fp"),
        F.count_if(lab & ~pred).alias("fn"),
        F.count_if(lab & pred).alias("tp"),
    ]


def classification_from_counts(tn: Column, fp: Column, fn: Column, tp: Column) -> list[Column]:
    """A5, A6 from confusion counts: precision, recall, macro F1 over present classes."""

    def ratio(num: Column, den: Column) -> Column:
        return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)

    precision = ratio(tp, tp + fp)
    recall = ratio(tp, tp + fn)
    f1_pos = ratio(2 * tp, 2 * tp + fp + fn)
    f1_neg = ratio(2 * tn, 2 * tn + fn + fp)
    pos_present = (tp + fn + fp) > 0
    neg_present = (tn + fp + fn) > 0
    n_present = pos_present.cast("int") + neg_present.cast("int")
    total = F.when(pos_present, f1_pos).otherwise(0.0) + F.when(neg_present, f1_neg).otherwise(0.0)
    macro = F.when(n_present > 0, total / n_present)
    return [precision.alias("precision"), recall.alias("recall"), macro.alias("macro_f1")]


def anomaly_metrics(
    df: DataFrame, label: str | Column, prediction: str | Column, *, by: Sequence[str] = ()
) -> DataFrame:
    """Confusion counts ``[[tn, fp], [fn, tp]]``, precision, recall, macro F1."""

    cols = confusion_columns(label, prediction)
    if by:
        counts = df.groupBy(*by).agg(*cols)
    else:
        rows = _not_empty(F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp"))
        counts = df.agg(*cols).withColumn("tn", rows - F.col("fp") - F.col("fn") - F.col("tp"))
    return counts.select(
        *by, "tn", "fp", "fn", "tp",
        *classification_from_counts(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")),
    )


def mean_ignoring_nan(c: str | Column) -> Column:
    """Mean that skips NULL and NaN."""

    x = _c(c)
    return F.avg(F.when(~F.isnan(x), x))
