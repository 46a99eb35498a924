"""Rolling-origin backtest in one distributed pass (ridge).

The reference refits the model once per expanding fold.  Ridge needs only the
moments of the training rows, and fold k's training rows are blocks 0..k
(block 0 = the initial window, then one block per step).  So:

  pass 1  means of features and target (centring, for precision)
  pass 2  ``groupBy(block)`` of the centred moments -- one row per fold
  then    prefix sums over blocks, and one k x k solve per fold (mapInPandas)
  pass 3  test rows tagged with their fold(s) arithmetically, joined to the
          fold coefficient table (one row per fold, by its size), predicted with
          a linear expression, and aggregated per fold (metrics and time bounds)

Random-forest backtests fit one Spark ML forest per fold.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlane.checks import check_choice, check_limits
from wattlane.functions.jsonsafe import iso_timestamp
from wattlane.operators.features import FeatureConfig
from wattlane.operators.metrics import forecast_metric_columns, mean_ignoring_nan
from wattlane.operators.ordering import chronological_row_number
from wattlane.operators.ridge import Moments, moment_columns, solve_ridge
from wattlane.operators.splits import FoldSpec, assign_test_folds, train_block, train_ends
from wattlane.plans.train import fit_forecaster, prepare_supervised
from wattlane.schema import TIMESTAMP, ZONE
from wattlane.session import cut_lineage


SPAN = 1024  # blocks whose running sums one task takes


def check_single_zone(panel: DataFrame, zone_col: str = ZONE, what: str = "Backtesting") -> None:
    """V9: exactly one distinct zone."""

    if zone_col not in panel.columns:
        raise ValueError(f"Missing zone column required for backtesting: {zone_col}")
    zones = panel.agg(F.countDistinct(zone_col)).first()[0]
    if zones != 1:
        raise ValueError(f"{what} currently supports exactly one zone. Found {zones} zones.")


@dataclass
class BacktestConfig:
    forecast_horizon: int = 24
    model: str = "ridge"
    initial_train_size: int = 1000
    fold_size: int = 168
    step_size: int = 168
    random_state: int = 42
    alpha: float = 1.0
    strict_single_zone: bool = True
    feature: FeatureConfig | None = None
    purge: int = 0  # training rows end this many rows before each cut (use the horizon to avoid leakage)
    excluded_columns: tuple[str, ...] = ()  # numeric columns that are no features

    def __post_init__(self) -> None:
        check_limits(self, {"forecast_horizon": 1})
        check_choice("model", self.model, ("ridge", "random_forest"))
        FoldSpec(self.initial_train_size, self.fold_size, self.step_size)
        if not 0 <= self.purge <= self.initial_train_size - 2:
            raise ValueError("purge must leave at least two training rows.")


def ridge_fold_coefficients(
    numbered: DataFrame, features: list[str], target: str, spec: FoldSpec, count: int, alpha: float,
    center: dict[str, float] | None = None, purge: int = 0,
) -> DataFrame:
    """fold, intercept, c0..: the coefficients of every fold from one grouped moment pass.

    ``center`` (close to the means, e.g. the supervised-row means) keeps the
    moments well conditioned; without it one extra means pass runs first.
    The running sums over the blocks take two levels, within spans of
    ``SPAN`` blocks and over the spans, and the solves run in ``mapInPandas``,
    so any number of folds stays distributed.
    """

    train_rows = numbered.where(F.col("rn") < spec.cut(count - 1) - purge)
    cols = [*features, target]
    if center is None or any(c not in center for c in cols):
        means = train_rows.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
        center = {c: float(means[f"m{i}"] or 0.0) for i, c in enumerate(cols)}
    moments = moment_columns(features, target, center)
    blocks = cut_lineage(train_rows.groupBy(train_block(F.col("rn"), spec, purge).alias("fold")).agg(*moments))
    names = [c for c in blocks.columns if c != "fold"]
    blocks = blocks.withColumn("span", F.floor(F.col("fold") / SPAN))
    spans = blocks.groupBy("span").agg(*[F.sum(c).alias(c) for c in names])
    before = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("span", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"b_{c}") for c in names])
    within = Window.partitionBy("span").orderBy("fold").rowsBetween(Window.unboundedPreceding, 0)
    running = blocks.select("fold", "span", *[F.sum(c).over(within).alias(c) for c in names]).join(spans, "span")
    running = running.select("fold", *[(F.col(c) + F.col(f"b_{c}")).alias(c) for c in names])
    k, cx, cy = len(features), np.array([center[f] for f in features]), center[target]

    def solve(batches):
        for pdf in batches:
            solved = [solve_ridge(Moments.from_row(r, k), cx, cy, alpha) for r in pdf.to_dict("records")]
            out = {"fold": pdf["fold"], "intercept": [b for _, b in solved]}
            yield pd.DataFrame(out | {f"c{i}": [float(c[i]) for c, _ in solved] for i in range(k)})

    return running.mapInPandas(solve, ", ".join(["fold BIGINT", "intercept DOUBLE", *[f"c{i} DOUBLE" for i in range(k)]]))


def run_backtest(
    panel: DataFrame, cfg: BacktestConfig | None = None, metrics_dir: str | None = None
) -> tuple[dict[str, Any], DataFrame]:
    """E2; returns the metrics document and the fold table.

    With ``metrics_dir`` both are written there, the folds as JSON records: their
    number grows with the table, so they never are a list on the driver.
    """

    cfg = cfg or BacktestConfig()
    if cfg.strict_single_zone:
        check_single_zone(panel)
    fc = cfg.feature or FeatureConfig(forecast_horizon=cfg.forecast_horizon)
    sup = prepare_supervised(panel, fc, cfg.excluded_columns)
    numbered = cut_lineage(chronological_row_number(sup.frame))  # all passes read it
    sup.release()
    spec = FoldSpec(cfg.initial_train_size, cfg.fold_size, cfg.step_size)
    count = spec.count(sup.rows)
    spark = panel.sparkSession
    target = fc.target_column
    tested = assign_test_folds(numbered, spec, count)
    if cfg.model == "ridge":
        table = cut_lineage(
            ridge_fold_coefficients(numbered, sup.features, target, spec, count, cfg.alpha, sup.means, cfg.purge))
        pred = F.col("intercept")
        for i, f in enumerate(sup.features):
            pred = pred + F.col(f"c{i}") * F.col(f).cast("double")
        predicted = tested.join(table, "fold").withColumn("prediction", pred)
    else:
        parts = []
        for fold in range(count):  # one forest each: the number of folds is what a user can afford to fit
            model = fit_forecaster(numbered.where(F.col("rn") < spec.cut(fold) - cfg.purge), sup.features, target, cfg.model,
                                   random_state=cfg.random_state, forecast_horizon=cfg.forecast_horizon)
            parts.append(model.predict(tested.where(F.col("fold") == fold)))
        predicted = parts[0]
        for p in parts[1:]:
            predicted = predicted.unionByName(p)
    per_fold = predicted.groupBy("fold").agg(
        *forecast_metric_columns(target, "prediction"),
        F.min(TIMESTAMP).alias("test_start_ts"), F.max(TIMESTAMP).alias("test_end_ts"),
    )
    ends = train_ends(numbered, spec, count, purge=cfg.purge)
    first_ts = numbered.where(F.col("rn") == 0).select(F.col(TIMESTAMP).alias("train_start_ts"))
    folds = (
        per_fold.join(ends, "fold")
        .crossJoin(F.broadcast(first_ts))  # the row at rn = 0
        .select(
            F.col("fold").cast("long").alias("fold"),
            (F.lit(cfg.initial_train_size - cfg.purge) + F.col("fold") * cfg.step_size).cast("long").alias("train_rows"),
            F.col("rows").alias("test_rows"),
            iso_timestamp("train_start_ts").alias("train_start"),
            iso_timestamp("train_end_ts").alias("train_end"),
            iso_timestamp("test_start_ts").alias("test_start"),
            iso_timestamp("test_end_ts").alias("test_end"),
            "mae", "rmse", "mape", "r2",
        )
    )
    folds = cut_lineage(folds)
    metrics = ("mae", "rmse", "mape", "r2")
    aggregate: dict[str, Any] = folds.agg(
        F.count(F.lit(1)).alias("fold_count"), *[mean_ignoring_nan(m).alias(f"mean_{m}") for m in metrics]
    ).first().asDict()
    output = {
        "model": cfg.model, "forecast_horizon": cfg.forecast_horizon,
        "initial_train_size": cfg.initial_train_size, "fold_size": cfg.fold_size, "step_size": cfg.step_size,
        "random_state": cfg.random_state, "aggregate_metrics": aggregate,
    }
    if metrics_dir:
        from wattlane.sources.sinks import write_json_metrics

        key = f"backtest_{cfg.model}_h{cfg.forecast_horizon}"
        write_json_metrics(spark, output, f"{metrics_dir}/{key}")
        fold_records(folds).write.mode("overwrite").json(f"{metrics_dir}/{key}_folds")
    return output, folds


def fold_records(folds: DataFrame) -> DataFrame:
    """The fold table as records with nested ``metrics``."""

    return folds.select(*[c for c in folds.columns if c not in ("mae", "rmse", "mape", "r2")],
                        F.struct("mae", "rmse", "mape", "r2").alias("metrics")).orderBy("fold")
