"""Train, evaluate and residual-score one chronological (or hashed) split.

Plan: features (one windowed projection, cached) -> supervised rows (one
aggregate) -> distributed row number -> fit (moment aggregates) -> one
aggregate grouped by split that yields test forecast metrics *and* the
training residual statistics -> map-only scoring -> one confusion aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.operators.detectors import ResidualZScoreDetector
from wattlane.operators.features import FeatureConfig, Supervised, build_feature_frame, build_supervised_frame
from wattlane.operators.forest import fit_forest
from wattlane.operators.metrics import anomaly_metrics, forecast_metric_columns
from wattlane.operators.ridge import fit_ridge
from wattlane.operators.splits import NumberedSplit, train_test_split
from wattlane.schema import LABEL_COLUMNS, TARGET
from wattlane.session import cut_lineage


def fit_forecaster(df: DataFrame, features: list[str], target: str, model: str, **kw: Any):
    """M6: choose the estimator by name."""

    if model == "ridge":
        return fit_ridge(df, features, target, **{k: v for k, v in kw.items() if k != "model"})
    if model == "random_forest":
        return fit_forest(df, features, target, **{k: v for k, v in kw.items() if k in {"random_state", "forecast_horizon", "max_depth", "num_trees"}})
    raise ValueError(f"Unsupported model type: {model}")


def find_label_column(df: DataFrame) -> str | None:
    for c in LABEL_COLUMNS:
        if c in df.columns:
            return c
    return None


@dataclass
class TrainConfig:
    forecast_horizon: int = 24
    model: str = "ridge"
    test_size: float = 0.2
    split_method: str = "chronological"
    random_state: int = 42
    threshold: float = 3.0
    feature: FeatureConfig | None = None
    purge: int = 0  # drop the last rows before the test cut (use the horizon to avoid target leakage)
    excluded_columns: tuple[str, ...] = ()  # numeric columns that are no features

    def feature_config(self) -> FeatureConfig:
        return self.feature or FeatureConfig(forecast_horizon=self.forecast_horizon)


@dataclass
class TrainResult:
    model: Any
    detector: ResidualZScoreDetector
    forecast: dict[str, Any]
    anomaly: dict[str, Any]
    scored: DataFrame = field(repr=False)
    supervised: Supervised = field(repr=False)


def prepare_supervised(panel: DataFrame, fc: FeatureConfig, excluded: Iterable[str] = ()) -> Supervised:
    feat = build_feature_frame(panel, fc).persist(StorageLevel.MEMORY_AND_DISK)
    shifted = {f"target_{c}" for c in fc.lead_columns}  # shifted labels are never features
    sup = build_supervised_frame(feat, fc.target_column, excluded_columns=shifted | set(excluded))
    sup.cached = feat
    return sup


def run_training(
    panel: DataFrame, cfg: TrainConfig | None = None, metrics_dir: str | None = None, model_dir: str | None = None
) -> TrainResult:
    """E1; writes the two metric documents to ``metrics_dir`` (S4), model and detector to ``model_dir``."""

    cfg = cfg or TrainConfig()
    fc = cfg.feature_config()
    sup = prepare_supervised(panel, fc, cfg.excluded_columns)
    split: NumberedSplit = train_test_split(
        sup.frame, cfg.test_size, split_method=cfg.split_method, random_state=cfg.random_state, rows=sup.rows,
        purge=cfg.purge, numbered=False,
    )
    labeled = split.frame
    extra = {"center": sup.means} if cfg.model == "ridge" else {}
    model = fit_forecaster(
        split.part("train"), sup.features, fc.target_column, cfg.model,
        forecast_horizon=cfg.forecast_horizon, random_state=cfg.random_state, **extra,
    )
    predicted = cut_lineage(
        model.predict(labeled).withColumn("residual", F.col(fc.target_column) - F.col("prediction"))
    )
    sup.release()
    # one pass: test forecast metrics and training residual statistics
    stats = predicted.groupBy("split").agg(
        *forecast_metric_columns(fc.target_column, "prediction"),
        F.avg("residual").alias("residual_mean"),
        F.stddev_pop("residual").alias("residual_std"),
    ).collect()
    by_split = {r["split"]: r for r in stats}
    test = by_split["test"]
    forecast = {
        "model": cfg.model, "forecast_horizon": cfg.forecast_horizon, "test_size": cfg.test_size,
        "split_method": cfg.split_method,
        "row_counts": {"train": split.counts["train"], "test": split.counts["test"]},
        "metrics": {k: test[k] for k in ("mae", "rmse", "mape", "r2")},
    }
    train = by_split["train"]
    std = train["residual_std"]
    detector = ResidualZScoreDetector(
        threshold=cfg.threshold, residual_mean_=float(train["residual_mean"]),
        residual_std_=float(std) if std and std > 0 else 1.0,
    )
    label = find_label_column(predicted)
    test_rows = predicted.where(F.col("split") == "test")
    if label is not None:  # keep the label apart from the detector's is_anomaly output
        test_rows = test_rows.withColumn("actual_anomaly", F.col(label).cast("boolean"))
    scored = detector.score_residuals(test_rows, "residual")
    if label is not None:
        m = anomaly_metrics(scored, "actual_anomaly", "is_anomaly").first()
        anomaly = {
            "records_scored": m["tn"] + m["fp"] + m["fn"] + m["tp"],
            "anomalies_detected": m["fp"] + m["tp"],
            "threshold": cfg.threshold,
            "labeled_metrics": {
                "precision": m["precision"], "recall": m["recall"], "macro_f1": m["macro_f1"],
                "confusion_matrix": [[m["tn"], m["fp"]], [m["fn"], m["tp"]]],
            },
        }
    else:
        r = scored.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_anomaly").alias("k")).first()
        anomaly = {"records_scored": r["n"], "anomalies_detected": r["k"], "threshold": cfg.threshold}
    if metrics_dir:
        from wattlane.sources.sinks import write_json_metrics

        keys = result_keys(cfg)
        write_json_metrics(panel.sparkSession, forecast, f"{metrics_dir}/{keys['forecast_metrics']}")
        write_json_metrics(panel.sparkSession, anomaly, f"{metrics_dir}/{keys['anomaly_metrics']}")
    if model_dir:
        from wattlane.sources.artifacts import save_detector

        path = f"{model_dir}/{result_keys(cfg)['forecast_metrics']}"
        model.save(panel.sparkSession, path) if cfg.model == "ridge" else model.save(path)
        save_detector(panel.sparkSession, detector, f"{model_dir}/{result_keys(cfg)['anomaly_metrics']}")
    return TrainResult(model, detector, forecast, anomaly, scored, sup)


def result_keys(cfg: TrainConfig) -> dict[str, str]:
    """Run keys of the written artefacts (S4 naming)."""

    return {
        "forecast_metrics": f"forecast_{cfg.model}_h{cfg.forecast_horizon}",
        "anomaly_metrics": "anomaly_residual_zscore",
    }


__all__ = ["TrainConfig", "TrainResult", "run_training", "fit_forecaster", "find_label_column", "TARGET"]
