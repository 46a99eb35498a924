"""Residual z-score and robust residual detectors.

Fitting is one aggregate (mean / population std) or one exact distributed
quantile job (median, MAD, IQR).  Pooled parameters are a handful of floats
and are inlined as literals, so scoring is a map-only projection inside
whole-stage codegen.  Per-group parameters (``by=("zone",)``) stay a small
DataFrame that is joined on the group key; a group without parameters of its
own (absent from the fit, or without a known residual in it) is scored with
those of all rows.

A NULL or NaN residual is missing: no parameter is fitted on it, its score
stays missing, and it is never flagged.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.functions.missing import known
from wattlane.operators.quantiles import exact_quantiles
from wattlane.schema import IQR_TO_SIGMA, MODIFIED_Z


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def residual(actual: str | Column, predicted: str | Column) -> Column:
    """C5."""

    return _c(actual).cast("double") - _c(predicted).cast("double")


def guard_scale(scale: Column, fallback: Column | float = 1.0) -> Column:
    """Non-finite or zero scale becomes the fallback."""

    fb = fallback if isinstance(fallback, Column) else F.lit(float(fallback))
    bad = scale.isNull() | F.isnan(scale) | (scale == 0) | (F.abs(scale) == float("inf"))
    return F.when(bad, fb).otherwise(scale)


def _finite_positive(x: float | None) -> bool:
    return x is not None and math.isfinite(x) and x != 0.0


def flagged(score: Column, threshold: float | Column) -> Column:
    """At the threshold or above; a missing score (Spark ranks NaN above all numbers) is not."""

    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.coalesce((score >= limit) & ~F.isnan(score), F.lit(False))


def _score_frame(df: DataFrame, score: Column, threshold: float) -> DataFrame:
    return df.withColumn("anomaly_score", score).withColumn("is_anomaly", flagged(F.col("anomaly_score"), threshold))


def _or_pooled(column: str, pooled: float | None) -> Column:
    """A group's parameter, that of all rows where the group has none."""

    return F.col(column) if pooled is None else F.coalesce(F.col(column), F.lit(float(pooled)))


# ---------------------------------------------------------------- z-score


@dataclass
class ResidualZScoreDetector:
    """D3: mean and population std of training residuals; flag ``|z| >= threshold``."""

    threshold: float = 3.0
    by: tuple[str, ...] = ()
    residual_mean_: float | None = None
    residual_std_: float | None = None
    params_: DataFrame | None = field(default=None, repr=False)

    def fit(self, df: DataFrame, actual: str | Column, predicted: str | Column) -> "ResidualZScoreDetector":
        return self.fit_residuals(df, residual(actual, predicted))

    def fit_residuals(self, df: DataFrame, res: str | Column) -> "ResidualZScoreDetector":
        r = known(_c(res))
        std = F.stddev_pop(r)
        aggs = [F.count(r).alias("n"), F.avg(r).alias("residual_mean"),
                F.when((std > 0) & ~F.isnan(std), std).otherwise(F.lit(1.0)).alias("residual_std")]
        if self.by:
            self.params_ = df.groupBy(*self.by).agg(*aggs).where("n > 0").drop("n")
        row = df.agg(*aggs).first()
        if not row["n"]:
            raise ValueError("residuals must not be empty.")
        self.residual_mean_ = float(row["residual_mean"])
        self.residual_std_ = float(row["residual_std"])
        return self

    def score(self, df: DataFrame, actual: str | Column, predicted: str | Column) -> DataFrame:
        return self.score_residuals(df, residual(actual, predicted))

    def score_residuals(self, df: DataFrame, res: str | Column) -> DataFrame:
        r = _c(res)
        if self.by:
            if self.params_ is None:
                raise ValueError("ResidualZScoreDetector must be fitted before scoring.")
            joined = df.join(self.params_, list(self.by), "left")
            mean, std = _or_pooled("residual_mean", self.residual_mean_), _or_pooled("residual_std", self.residual_std_)
            z = F.abs((r - mean) / guard_scale(std))
            return _score_frame(joined, z, self.threshold).drop("residual_mean", "residual_std")
        return _score_frame(df, self.pooled_score(r), self.threshold)

    def pooled_score(self, res: Column) -> Column:
        """C6 of a residual with the parameters of all rows."""

        if self.residual_mean_ is None or self.residual_std_ is None:
            raise ValueError("ResidualZScoreDetector must be fitted before scoring.")
        scale = self.residual_std_ if _finite_positive(self.residual_std_) else 1.0
        return F.abs((res - F.lit(self.residual_mean_)) / F.lit(scale))


# ---------------------------------------------------------------- robust


def robust_parameters(
    df: DataFrame, res: Column, by: Sequence[str] = (), center: float | None = None
) -> DataFrame:
    """A8 + A9 + C9: median (or the given ``center``), MAD with IQR/1.349 fallback, then 1.0; per group.

    Two exact quantile jobs: (q25, median, q75) of the residuals, then the
    median of absolute deviations from the group median.
    """

    vals = df.select(*by, known(res).alias("_wl_r"))
    q = exact_quantiles(vals, "_wl_r", [0.25, 0.5, 0.75], by=by, names=["q25", "median", "q75"])
    if center is not None:
        q = q.withColumn("median", F.lit(float(center)))
    if by:
        dev = vals.join(q.select(*by, "median"), list(by))
    else:
        dev = vals.crossJoin(F.broadcast(q.select("median")))  # one row
    mad = exact_quantiles(
        dev.select(*by, F.abs(F.col("_wl_r") - F.col("median")).alias("_wl_d")),
        "_wl_d", [0.5], by=by, names=["mad"],
    )
    both = q.join(mad, list(by)) if by else q.crossJoin(F.broadcast(mad))  # one row each
    iqr = (F.col("q75") - F.col("q25")) / F.lit(IQR_TO_SIGMA)
    scale = guard_scale(guard_scale(F.col("mad"), iqr), 1.0)
    return both.select(
        *by,
        F.col("median").alias("residual_median"),
        F.col("mad").alias("raw_mad"),
        iqr.alias("iqr_scale"),
        scale.alias("residual_mad"),
    )


@dataclass
class RobustResidualDetector:
    """Median / MAD of training residuals; modified z ``|0.6745 (r - med) / mad|``."""

    threshold: float = 3.5
    by: tuple[str, ...] = ()
    residual_median_: float | None = None
    residual_mad_: float | None = None
    params_: DataFrame | None = field(default=None, repr=False)

    def fit(self, df: DataFrame, actual: str | Column, predicted: str | Column) -> "RobustResidualDetector":
        return self.fit_residuals(df, residual(actual, predicted))

    def fit_residuals(self, df: DataFrame, res: str | Column) -> "RobustResidualDetector":
        params = robust_parameters(df, _c(res), self.by)
        if self.by:
            self.params_ = params.select(*self.by, "residual_median", "residual_mad")
            params = robust_parameters(df, _c(res))
        row = params.first()
        if row is None:
            raise ValueError("residuals must not be empty.")
        self.residual_median_ = float(row["residual_median"])
        self.residual_mad_ = float(row["residual_mad"])
        return self

    def score(self, df: DataFrame, actual: str | Column, predicted: str | Column) -> DataFrame:
        return self.score_residuals(df, residual(actual, predicted))

    def score_residuals(self, df: DataFrame, res: str | Column) -> DataFrame:
        r = _c(res)
        if self.by:
            if self.params_ is None:
                raise ValueError("RobustResidualDetector must be fitted before scoring.")
            joined = df.join(self.params_, list(self.by), "left")
            median, mad = _or_pooled("residual_median", self.residual_median_), _or_pooled("residual_mad", self.residual_mad_)
            z = F.abs(F.lit(MODIFIED_Z) * (r - median) / guard_scale(mad))
            return _score_frame(joined, z, self.threshold).drop("residual_median", "residual_mad")
        return _score_frame(df, self.pooled_score(r), self.threshold)

    def pooled_score(self, res: Column) -> Column:
        """C7 of a residual with the parameters of all rows."""

        if self.residual_median_ is None or self.residual_mad_ is None:
            raise ValueError("RobustResidualDetector must be fitted before scoring.")
        scale = self.residual_mad_ if _finite_positive(self.residual_mad_) else 1.0
        return F.abs(F.lit(MODIFIED_Z) * (res - F.lit(self.residual_median_)) / F.lit(scale))


# ---------------------------------------------------------------- self-fitting scorers


def score_residuals(
    df: DataFrame,
    actual: str | Column,
    predicted: str | Column,
    *,
    threshold: float = 3.0,
    residual_mean: float | None = None,
    residual_std: float | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Z-scores; statistics come from the scored rows unless given."""

    res = residual(actual, predicted)
    if residual_mean is not None and residual_std is not None:
        det = ResidualZScoreDetector(threshold=threshold, residual_mean_=residual_mean, residual_std_=residual_std)
        return det.score_residuals(df, res)
    r = known(res)
    aggs = [F.count(r).alias("_n"), F.avg(r).alias("_m"), F.stddev_pop(r).alias("_s")]
    if by:
        stats = df.groupBy(*by).agg(*aggs)
        joined = df.join(stats, list(by))
    else:
        row = df.agg(*aggs).first()
        if not row["_n"]:
            raise ValueError("actual and predicted values must not be empty.")
        mean = float(row["_m"]) if residual_mean is None else residual_mean
        std = float(row["_s"]) if residual_std is None else residual_std
        scale = std if _finite_positive(std) else 1.0
        return _score_frame(df, F.abs((res - F.lit(mean)) / F.lit(scale)), threshold)
    mean = F.col("_m") if residual_mean is None else F.lit(residual_mean)
    std = F.col("_s") if residual_std is None else F.lit(residual_std)
    out = _score_frame(joined, F.abs((res - mean) / guard_scale(std)), threshold)
    return out.drop("_n", "_m", "_s")


def score_robust_residuals(
    df: DataFrame,
    actual: str | Column,
    predicted: str | Column,
    *,
    threshold: float = 3.5,
    residual_median: float | None = None,
    residual_mad: float | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Modified z-scores; a zero MAD falls back to the IQR of the scored rows."""

    res = residual(actual, predicted)
    if residual_median is not None and residual_mad is not None and _finite_positive(residual_mad):
        det = RobustResidualDetector(threshold=threshold, residual_median_=residual_median, residual_mad_=residual_mad)
        return det.score_residuals(df, res)
    params = robust_parameters(df, res, by, center=residual_median)
    scale = F.col("raw_mad") if residual_mad is None else F.lit(float(residual_mad))
    params = params.select(
        *by, F.col("residual_median"), guard_scale(guard_scale(scale, F.col("iqr_scale")), 1.0).alias("residual_mad"))
    if not by:
        row = params.first()
        if row is None:
            raise ValueError("actual and predicted values must not be empty.")
        z = F.abs(F.lit(MODIFIED_Z) * (res - F.lit(row["residual_median"])) / F.lit(row["residual_mad"]))
        return _score_frame(df, z, threshold)
    joined = df.join(params, list(by))
    z = F.abs(F.lit(MODIFIED_Z) * (res - F.col("residual_median")) / F.col("residual_mad"))
    return _score_frame(joined, z, threshold).drop("residual_median", "residual_mad")
