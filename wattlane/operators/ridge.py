"""Ridge forecaster from sufficient statistics.

Standardised ridge (population-std scaling, free intercept, L2 penalty
``alpha`` in standardised space) depends on the data only through
``n``, ``sum x``, ``sum x x'``, ``sum x y`` and ``sum y``.  Those moments are
one distributed aggregate with map-side partial sums (centred on a first-pass
mean for precision); the k x k solve (k = number of features) runs on the
driver.  Grouping the same aggregate by a block column gives every expanding
fold of a backtest from one pass (see ``plans.backtest``).

Prediction is a linear expression over the feature columns (median
imputation via ``coalesce``), so it stays inside whole-stage codegen.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import UTC, datetime

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from wattlane.functions.missing import known
from wattlane.operators.quantiles import column_medians

_EPS = np.finfo(np.float64).eps


def _x(name: str) -> Column:
    return F.col(name).cast("double")


# ---------------------------------------------------------------- moments


def moment_columns(features: Sequence[str], target: str, center: dict[str, float] | None = None) -> list[Column]:
    """Aggregate expressions for n, sums, Gram entries (i <= j), x'y, y'y (centred)."""

    center = center or {}
    xs = [_x(f) - F.lit(center.get(f, 0.0)) for f in features]
    y = _x(target) - F.lit(center.get(target, 0.0))
    cols = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy")]
    for i, xi in enumerate(xs):
        cols.append(F.sum(xi).alias(f"s_{i}"))
        cols.append(F.sum(xi * y).alias(f"sxy_{i}"))
        for j in range(i, len(xs)):
            cols.append(F.sum(xi * xs[j]).alias(f"g_{i}_{j}"))
    return cols


@dataclass
class Moments:
    n: float
    s: np.ndarray
    g: np.ndarray
    sxy: np.ndarray
    sy: float
    syy: float

    @staticmethod
    def from_row(row: Row | dict, k: int) -> "Moments":
        d = row.asDict() if isinstance(row, Row) else row
        g = np.zeros((k, k))
        for i in range(k):
            for j in range(i, k):
                g[i, j] = g[j, i] = d[f"g_{i}_{j}"] or 0.0
        return Moments(
            n=float(d["n"] or 0),
            s=np.array([d[f"s_{i}"] or 0.0 for i in range(k)]),
            g=g,
            sxy=np.array([d[f"sxy_{i}"] or 0.0 for i in range(k)]),
            sy=float(d["sy"] or 0.0),
            syy=float(d["syy"] or 0.0),
        )

    def __add__(self, other: "Moments") -> "Moments":
        return Moments(self.n + other.n, self.s + other.s, self.g + other.g,
                       self.sxy + other.sxy, self.sy + other.sy, self.syy + other.syy)


def solve_ridge(m: Moments, center_x: np.ndarray, center_y: float, alpha: float) -> tuple[np.ndarray, float]:
    """Coefficients in original units and intercept, from centred moments."""

    n = m.n
    if n <= 0:
        raise ValueError("features must contain at least one row.")
    mean_shift = m.s / n
    scatter = m.g - np.outer(m.s, m.s) / n
    cxy = m.sxy - m.s * m.sy / n
    var = np.clip(np.diag(scatter) / n, 0.0, None)
    means = center_x + mean_shift
    sd = np.sqrt(var)
    constant = var <= (_EPS * np.maximum(np.abs(means), 1.0)) ** 2 * n
    sd = np.where(constant | (sd == 0), 1.0, sd)
    zz = scatter / np.outer(sd, sd)
    zy = cxy / sd
    w = np.linalg.solve(zz + alpha * np.eye(len(sd)), zy)
    coef = w / sd
    intercept = center_y + m.sy / n - float(np.dot(coef, means))
    return coef, float(intercept)


# ---------------------------------------------------------------- model


@dataclass
class RidgeModel:
    feature_names: list[str]
    coefficients: list[float]
    intercept: float
    medians: dict[str, float | None] = field(default_factory=dict)
    alpha: float = 1.0
    model_type: str = "ridge"
    target_column: str = "target_load_mw"
    forecast_horizon: int = 24
    random_state: int | None = 42
    version: str = "0.1.0"
    created_at_utc: str = ""

    def prediction_column(self, value: Callable[[str], Column] = F.col) -> Column:
        """M7 as one codegen-friendly expression over ``value(feature)``; a NULL or NaN feature takes its median."""

        expr = F.lit(self.intercept)
        for name, c in zip(self.feature_names, self.coefficients):
            x = known(value(name))
            med = self.medians.get(name)
            if med is not None:
                x = F.coalesce(x, F.lit(float(med)))
            expr = expr + F.lit(float(c)) * x
        return expr

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        missing = [f for f in self.feature_names if f not in df.columns]
        if missing:
            raise ValueError(f"Missing required model features: {', '.join(missing)}.")
        return df.withColumn(name, self.prediction_column())

    # The bundle is a small parameter table (one row per feature)
    def to_frame(self, spark: SparkSession) -> DataFrame:
        meta = json.dumps({
            "model_type": self.model_type, "version": self.version, "created_at_utc": self.created_at_utc,
            "feature_names": self.feature_names, "target_column": self.target_column,
            "forecast_horizon": self.forecast_horizon, "random_state": self.random_state,
            "alpha": self.alpha, "intercept": self.intercept,
        })
        rows = [(i, f, float(c), self.medians.get(f), meta)
                for i, (f, c) in enumerate(zip(self.feature_names, self.coefficients))]
        return spark.createDataFrame(
            rows, "position INT, feature STRING, coefficient DOUBLE, median DOUBLE, metadata STRING"
        )

    def save(self, spark: SparkSession, path: str) -> str:
        self.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(path)
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> "RidgeModel":
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r["position"])
        meta = json.loads(rows[0]["metadata"])
        return RidgeModel(
            feature_names=[r["feature"] for r in rows],
            coefficients=[r["coefficient"] for r in rows],
            intercept=meta["intercept"],
            medians={r["feature"]: r["median"] for r in rows},
            alpha=meta["alpha"], model_type=meta["model_type"], target_column=meta["target_column"],
            forecast_horizon=meta["forecast_horizon"], random_state=meta["random_state"],
            version=meta["version"], created_at_utc=meta["created_at_utc"],
        )


def fit_ridge(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    *,
    alpha: float = 1.0,
    impute: bool = True,
    forecast_horizon: int = 24,
    random_state: int | None = 42,
    center: dict[str, float] | None = None,
) -> RidgeModel:
    """M3/M6: the exact medians fill missing features, then one centred-moment aggregate
    (plus a means pass when no centre is given).

    ``center`` only needs to be close to the means (e.g. the supervised-row
    means); the solve corrects for the offset exactly. NaN is missing: the
    medians fill it, and a row without a known target is left out of the fit.
    """

    features = list(features)
    if not features:
        raise ValueError("feature_names must not be empty.")
    k = len(features)
    cols = [*features, target]
    medians = column_medians(df, features) if impute else {}
    filled = {f: F.coalesce(known(f), F.lit(float(m))) for f, m in medians.items() if m is not None}
    df = df.select(*[filled.get(f, known(f)).alias(f) for f in features], known(target).alias(target))
    df = df.where(F.col(target).isNotNull())
    if center is None or any(c not in center for c in cols):
        mean_row = df.agg(*[F.avg(_x(c)).alias(f"m_{i}") for i, c in enumerate(cols)]).first()
        center = {c: float(mean_row[f"m_{i}"] or 0.0) for i, c in enumerate(cols)}
    mom = Moments.from_row(df.agg(*moment_columns(features, target, center)).first(), k)
    if not mom.n:
        raise ValueError("features must contain at least one row.")
    coef, intercept = solve_ridge(mom, np.array([center[f] for f in features]), center[target], alpha)
    from wattlane import __version__

    return RidgeModel(
        feature_names=features, coefficients=[float(c) for c in coef], intercept=intercept,
        medians=medians, alpha=alpha, target_column=target, forecast_horizon=forecast_horizon,
        random_state=random_state, version=__version__, created_at_utc=datetime.now(tz=UTC).isoformat(),
    )


def univariate_ridge_columns(x: str, y: str, alpha: float = 1.0) -> list[Column]:
    """Closed-form one-feature standardised ridge as aggregate expressions.

    slope_std = n cov(x, y) / (n + alpha) / sd(x); intercept = mean(y) - coef mean(x).
    """

    n = F.count(F.lit(1))
    sd = F.sqrt(F.var_pop(_x(x)))
    sd_safe = F.when(sd > 0, sd).otherwise(F.lit(1.0))
    w = n * F.covar_pop(_x(x), _x(y)) / sd_safe / (n + F.lit(alpha))
    coef = w / sd_safe
    return [n.alias("rows"), coef.alias("coefficient"), (F.avg(_x(y)) - coef * F.avg(_x(x))).alias("intercept")]


# ---------------------------------------------------------------- one model per zone


@dataclass
class ZoneRidgeModel:
    """Per-group ridge coefficients as a table: group keys, intercept, c0..c{k-1}."""

    feature_names: list[str]
    by: list[str]
    coefficients: DataFrame = field(repr=False)
    alpha: float = 1.0

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Equi-join on the group keys (one coefficient row per group; AQE picks the join)."""

        pred = F.col("_wl_b")
        for i, f in enumerate(self.feature_names):
            pred = pred + F.col(f"_wl_c{i}") * _x(f)
        joined = df.join(self.coefficients, self.by, "left")
        return joined.withColumn(name, pred).drop("_wl_b", *[f"_wl_c{i}" for i in range(len(self.feature_names))])


def fit_ridge_by(
    df: DataFrame, features: Sequence[str], target: str, by: Sequence[str], *, alpha: float = 1.0,
    center: dict[str, float] | None = None,
) -> ZoneRidgeModel:
    """Fit one standardised ridge per group from one grouped moment aggregate.

    Moments are summed per group with map-side partial aggregation; the k x k
    solve of every group runs in ``mapInPandas`` over the (one row per
    group) moment table, so many groups never pass through the driver.
    """

    features, by = list(features), list(by)
    k = len(features)
    cols = [*features, target]
    df = df.na.drop(subset=cols)
    if center is None or any(c not in center for c in cols):
        row = df.agg(*[F.avg(_x(c)).alias(f"m_{i}") for i, c in enumerate(cols)]).first()
        center = {c: float(row[f"m_{i}"] or 0.0) for i, c in enumerate(cols)}
    moments = df.groupBy(*by).agg(*moment_columns(features, target, center))
    cx = np.array([center[f] for f in features])
    cy = center[target]
    out_cols = [*by, "_wl_b", *[f"_wl_c{i}" for i in range(k)]]
    key_types = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name in by}
    schema = ", ".join([*(f"`{b}` {key_types[b]}" for b in by), "_wl_b DOUBLE", *(f"_wl_c{i} DOUBLE" for i in range(k))])

    def solve(batches):
        for pdf in batches:  # one row per group
            solved = [solve_ridge(Moments.from_row(r, k), cx, cy, alpha) for r in pdf.to_dict("records")]
            out = pdf[by].copy()
            out["_wl_b"] = [b for _, b in solved]
            for i in range(k):
                out[f"_wl_c{i}"] = [float(coef[i]) for coef, _ in solved]
            yield out[out_cols]

    coefs = moments.mapInPandas(solve, schema)
    return ZoneRidgeModel(features, by, coefs, alpha)
