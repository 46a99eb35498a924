"""Registered queries of the fitted workflows on two features, with DuckDB SQL that solves the 2 x 2 normal equations.

All other numeric columns are excluded, so that SQL can say what the moment
aggregates, the solves and the scoring of the very same jobs must give.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.catalog_panels import scratch
from wattlane.operators.detectors import ResidualZScoreDetector
from wattlane.operators.features import FeatureConfig, add_forecast_target, add_lag_features
from wattlane.operators.isoforest import IsolationForestModel, average_path_length
from wattlane.operators.ridge import fit_ridge, fit_ridge_by
from wattlane.operators.splits import train_test_split
from wattlane.plans.anomaly import AnomalyConfig, run_anomaly_evaluation, run_anomaly_tuning
from wattlane.plans.backtest import BacktestConfig, run_backtest
from wattlane.plans.requests import payload_json, payload_records
from wattlane.plans.train import TrainConfig, run_training
from wattlane.schema import TARGET
from wattlane.sources import store
from wattlane.sources.adapters import events_panel

FEATURES = FeatureConfig(lag_periods=(24,), rolling_windows=())
EXCLUDED = ("temperature_c", "wind_speed_mps", "solar_radiation_wm2", "hour", "day_of_week", "month", "is_weekend")
METHODS = ("residual_zscore", "robust_residual")


def _round(c: str) -> Column:
    x = F.col(c)
    return F.round(x + (F.abs(x) * F.lit(1e-12) + F.lit(1e-9)), 6).alias(c)


def _labelled(panel: DataFrame) -> DataFrame:
    return panel.withColumn("is_anomaly", F.col("solar_radiation_wm2") % 50 == 0)


def training_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions and anomaly scores of the test rows."""

    res = run_training(events_panel(spark, sf), TrainConfig(feature=FEATURES, excluded_columns=EXCLUDED))
    return res.scored.select("zone", "timestamp", _round("prediction"), _round("anomaly_score"), "is_anomaly")


def training_report(spark: SparkSession, sf: str) -> DataFrame:
    """The metric documents of a labelled training run, as one row."""

    res = run_training(_labelled(events_panel(spark, sf)), TrainConfig(feature=FEATURES, excluded_columns=EXCLUDED, purge=24))
    (tn, fp), (fn, tp) = res.anomaly["labeled_metrics"]["confusion_matrix"]
    row = {**res.forecast["row_counts"], **res.forecast["metrics"], "tn": tn, "fp": fp, "fn": fn, "tp": tp,
           **{k: res.anomaly["labeled_metrics"][k] for k in ("precision", "recall", "macro_f1")}}
    schema = ", ".join(f"{k} {'BIGINT' if isinstance(v, int) else 'DOUBLE'}" for k, v in row.items())
    df = spark.createDataFrame([tuple(row.values())], schema)
    return df.select(*[_round(k) if isinstance(v, float) else F.col(k) for k, v in row.items()])


def zone_training(spark: SparkSession, sf: str) -> DataFrame:
    """M3 by zone: every zone's own coefficients, from one grouped aggregate."""

    rows = add_forecast_target(add_lag_features(events_panel(spark, sf), FEATURES), FEATURES)
    s = train_test_split(rows.na.drop(subset=["load_mw", "lag_24", TARGET]), 0.2, numbered=False)
    model = fit_ridge_by(s.part("train"), ["load_mw", "lag_24"], TARGET, ["zone"])
    return model.predict(s.part("test")).select("zone", "timestamp", _round("prediction"))


def backtest_folds(spark: SparkSession, sf: str) -> DataFrame:
    """The fold table of a rolling-origin backtest."""

    cfg = BacktestConfig(feature=FEATURES, excluded_columns=EXCLUDED, initial_train_size=500, fold_size=100, step_size=150)
    try:
        _, folds = run_backtest(events_panel(spark, sf, single_zone=True), cfg)
    except ValueError as exc:  # a table too short for one fold has no folds (the library raises)
        if "Not enough supervised rows" not in str(exc):
            raise
        folds = spark.createDataFrame([], "fold BIGINT, train_rows BIGINT, test_rows BIGINT, train_start STRING, "
                                          "train_end STRING, test_start STRING, test_end STRING, mae DOUBLE, "
                                          "rmse DOUBLE, mape DOUBLE, r2 DOUBLE")
    return folds.select(*folds.columns[:7], *[_round(c) for c in ("mae", "rmse", "mape", "r2")])


def _results(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    df = spark.createDataFrame(rows, "method STRING, threshold DOUBLE, detected_count BIGINT, tn BIGINT, fp BIGINT, fn BIGINT, "
                                     "tp BIGINT, precision DOUBLE, recall DOUBLE, macro_f1 DOUBLE")
    return df.select(*df.columns[:7], *[_round(c) for c in ("precision", "recall", "macro_f1")])


def _flat(method: str, threshold: float, r: dict) -> tuple:
    (tn, fp), (fn, tp) = r["confusion_matrix"]
    return method, threshold, r["detected_count"], tn, fp, fn, tp, r["precision"], r["recall"], r["macro_f1"]


def evaluation_report(spark: SparkSession, sf: str) -> DataFrame:
    """The residual methods of ``run_anomaly_evaluation`` side by side."""

    cfg = AnomalyConfig(feature=FEATURES, excluded_columns=EXCLUDED, methods=METHODS, residual_zscore_threshold=1.5,
                        robust_residual_threshold=1.25)
    doc = run_anomaly_evaluation(_labelled(events_panel(spark, sf)), cfg)
    return _results(spark, [_flat(m, doc["methods"][m]["config"]["threshold"], doc["methods"][m]) for m in METHODS])


def tuning_report(spark: SparkSession, sf: str) -> DataFrame:
    """The thresholds that ``run_anomaly_tuning`` selects and their test results."""

    cfg = AnomalyConfig(feature=FEATURES, excluded_columns=EXCLUDED, methods=METHODS)
    doc = run_anomaly_tuning(_labelled(events_panel(spark, sf, single_zone=True)), cfg)
    return _results(spark, [_flat(m, doc["selected_config_by_method"][m]["threshold"], doc["test_results_by_method"][m])
                            for m in METHODS])


#: two trees over load and temperature: (tree, node, feature, threshold, left, right, size, depth)
NODES = [
    (0, 0, 0, 40.0, 1, 2, 16, 0), (0, 1, 1, 30.0, 3, 4, 10, 1), (0, 2, -1, 0.0, -1, -1, 6, 1),
    (0, 3, -1, 0.0, -1, -1, 7, 2), (0, 4, -1, 0.0, -1, -1, 3, 2),
    (1, 0, 1, 60.0, 1, 2, 16, 0), (1, 1, -1, 0.0, -1, -1, 15, 1), (1, 2, -1, 0.0, -1, -1, 1, 1),
]


def isolation_nodes(spark: SparkSession, sf: str) -> DataFrame:
    """Path lengths, score and strict flag of a given forest; missing features take its medians."""

    nodes = pd.DataFrame(NODES, columns=["tree", "node", "feature", "threshold", "left_child", "right_child", "size", "depth"])
    model = IsolationForestModel(["load_mw", "temperature_c"], {"load_mw": 50.0, "temperature_c": 10.0}, nodes, psi=16, trees=2,
                                 contamination="auto", offset=-0.5)
    solar = F.col("solar_radiation_wm2")
    panel = events_panel(spark, sf).withColumn(
        "load_mw", F.when(solar % 31 == 3, float("nan")).when(solar % 29 == 3, None).otherwise(F.col("load_mw")))
    return model.score(panel).select("zone", "timestamp", _round("anomaly_score"), "is_anomaly")


def payload_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The payload records read back from their JSON."""

    rows = add_forecast_target(add_lag_features(events_panel(spark, sf), FEATURES), FEATURES)
    records = payload_json(payload_records(rows.na.drop(subset=["lag_24", TARGET]), ["load_mw", "lag_24"], 50))
    features = F.from_json("forecast_record", "features map<string,double>")["features"]
    pair = F.from_json("anomaly_record", "actual_load_mw double, predicted_load_mw double")
    return records.select("zone", "timestamp", features["load_mw"].alias("load_mw"), features["lag_24"].alias("lag_24"),
                          pair["actual_load_mw"].alias("actual_load_mw"), pair["predicted_load_mw"].alias("predicted_load_mw"),
                          (F.col("batch_record") == F.col("forecast_record")).alias("same"))


def stored_models(spark: SparkSession, sf: str) -> DataFrame:
    """Two models and two versions of a detector by zone in one store; every version scores the test rows."""

    path = scratch(spark, "store")
    rows = add_forecast_target(add_lag_features(events_panel(spark, sf), FEATURES), FEATURES)
    s = train_test_split(rows.na.drop(subset=["load_mw", "lag_24", TARGET]), 0.2, numbered=False)
    train, test = s.part("train"), s.part("test")
    store.put(spark, path, "pooled", fit_ridge(train, ["load_mw", "lag_24"], TARGET, impute=False))
    store.put(spark, path, "by_zone", fit_ridge_by(train, ["load_mw", "lag_24"], TARGET, ["zone"]))
    for part in (train, test):
        store.put(spark, path, "detector", ResidualZScoreDetector(2.0, by=("zone",)).fit(part, TARGET, "load_mw"))
    out = test
    for name in ("pooled", "by_zone"):
        out = store.get(spark, path, name).predict(out, name)
    for version in (1, None):
        d = store.get(spark, path, "detector", version)
        out = d.score(out, TARGET, "load_mw").withColumnsRenamed({
            "anomaly_score": f"score_{version or 'last'}", "is_anomaly": f"flag_{version or 'last'}"})
    return out.select("zone", "timestamp", _round("pooled"), _round("by_zone"), _round("score_1"), "flag_1",
                      _round("score_last"), "flag_last")


QUERIES = {
    "stored_models": stored_models,
    "training_scores": training_scores,
    "training_report": training_report,
    "zone_training": zone_training,
    "backtest_folds": backtest_folds,
    "evaluation_report": evaluation_report,
    "tuning_report": tuning_report,
    "isolation_nodes": isolation_nodes,
    "payload_rows": payload_rows,
}


def _ridge(src: str, by: str = "") -> str:
    """CTEs mo, so, kk, k: coefficients k1 and k2 and intercept k0 of y on x1 and x2, by ``by``."""

    first = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""mo AS (
    SELECT {first}count(*)::DOUBLE AS n, avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, stddev_pop(x1) AS s1, stddev_pop(x2) AS s2,
      covar_pop(x1, x2) AS c12, covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2 FROM {src} {group}),
  so AS (SELECT *, n + 1.0 AS a, n * c12 / (s1 * s2) AS b, n * c1 / s1 AS d1, n * c2 / s2 AS d2 FROM mo),
  kk AS (SELECT *, (a * d1 - b * d2) / (a * a - b * b) / s1 AS k1, (a * d2 - b * d1) / (a * a - b * b) / s2 AS k2 FROM so),
  k AS (SELECT {first}k1, k2, my - k1 * m1 - k2 * m2 AS k0 FROM kk)"""


def _rounded(x: str) -> str:
    return f"round(({x}) + (abs({x}) * 1e-12 + 1e-9), 6)"


def oracles() -> dict[str, str]:
    from wattlane.oracle import PANEL, SINGLE, W, _classify, _confusion, _iso, _metrics, _robust_params, _split2, _split3, _zparams
    from wattlane.oracle import _stable_round as stable

    sup = f"""sup AS (SELECT *, {"solar_radiation_wm2 % 50 = 0"} AS lbl FROM (
    SELECT *, load_mw AS x1, lag(load_mw, 24) OVER ({W}) AS x2, lead(load_mw, 24) OVER ({W}) AS y FROM panel)
  WHERE x2 IS NOT NULL AND y IS NOT NULL)"""
    two = f"{sup}, {_split2('sup')}, train AS (SELECT * FROM labeled WHERE split = 'train')"
    predicted = "predicted AS (SELECT labeled.*, k0 + k1 * x1 + k2 * x2 AS p, y - (k0 + k1 * x1 + k2 * x2) AS residual FROM labeled, k)"
    purged = two.replace("WHERE split = 'train')", "WHERE split = 'train' AND rn < (SELECT train FROM cut) - 24)")
    purged_predicted = predicted.replace("FROM labeled, k)", "FROM labeled, k WHERE split = 'test' OR rn < (SELECT train FROM cut) - 24)")
    trained = "(SELECT * FROM predicted WHERE split = 'train')"
    z, r = "abs((residual - mu) / sd)", "abs(0.6745 * (residual - residual_median) / residual_mad)"
    three = f"{sup}, {_split3('sup')}, train AS (SELECT * FROM labeled WHERE split = 'train')"
    grid = ", ".join(
        [f"('residual_zscore', {i}, {t})" for i, t in enumerate((1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0))]
        + [f"('robust_residual', {i}, {t})" for i, t in enumerate((1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0, 6.0))])
    length = {s: float(average_path_length(np.array([s]))[0]) for s in (1, 3, 6, 7, 15, 16)}
    paths = f"""(CASE WHEN x <= 40 THEN CASE WHEN t <= 30 THEN {2 + length[7]!r} ELSE {2 + length[3]!r} END ELSE {1 + length[6]!r} END
    + CASE WHEN t <= 60 THEN {1 + length[15]!r} ELSE {1 + length[1]!r} END) / 2 / {length[16]!r}"""
    q = {
        "training_scores": f"""WITH {PANEL}, {two}, {_ridge('train')}, {predicted}, {_zparams(trained)}
SELECT zone, "timestamp", round(p, 6) AS prediction, round({z}, 6) AS anomaly_score, {z} >= 3.0 AS is_anomaly
FROM predicted, zp WHERE split = 'test'""",
        "training_report": f"""WITH {PANEL}, {purged}, {_ridge('train')}, {purged_predicted}, {_zparams(trained)},
  scored AS (SELECT *, {z} >= 3.0 AS flag FROM predicted, zp WHERE split = 'test'),
  a AS (SELECT {_metrics('y', 'p')} FROM scored), c AS (SELECT {_confusion('lbl', 'flag')} FROM scored)
SELECT (SELECT count(*) FROM train) AS train, a.rows AS test, mae, rmse, mape, r2, tn, fp, fn, tp, {_classify()} FROM a, c""",
        "zone_training": f"""WITH {PANEL}, {two}, {_ridge('train', 'zone')}
SELECT zone, "timestamp", round(k0 + k1 * x1 + k2 * x2, 6) AS prediction FROM labeled JOIN k USING (zone) WHERE split = 'test'""",
        "stored_models": f"""WITH {PANEL}, {two}, {_ridge('train')},
  kz AS (WITH {_ridge('train', 'zone')} SELECT * FROM k),
  d1 AS (SELECT zone, avg(y - x1) AS c, stddev_pop(y - x1) AS s FROM train GROUP BY zone),
  d2 AS (SELECT zone, avg(y - x1) AS c, stddev_pop(y - x1) AS s FROM labeled WHERE split = 'test' GROUP BY zone),
  z AS (SELECT zone, "timestamp", k.k0 + k.k1 * x1 + k.k2 * x2 AS p, kz.k0 + kz.k1 * x1 + kz.k2 * x2 AS pz,
    abs((y - x1 - d1.c) / d1.s) AS s1, abs((y - x1 - d2.c) / d2.s) AS s2
    FROM labeled CROSS JOIN k JOIN kz USING (zone) JOIN d1 USING (zone) JOIN d2 USING (zone) WHERE split = 'test')
SELECT zone, "timestamp", round(p, 6) AS pooled, round(pz, 6) AS by_zone, round(s1, 6) AS score_1, s1 >= 2.0 AS flag_1,
  round(s2, 6) AS score_last, s2 >= 2.0 AS flag_last FROM z""",
        "backtest_folds": f"""WITH {SINGLE}, {sup},
  numbered AS (SELECT *, row_number() OVER (ORDER BY "timestamp", zone) - 1 AS rn FROM sup),
  folds AS (SELECT unnest(range(0, (count(*) - 500 - 100) // 150 + 1)) AS fold FROM sup),
  taught AS (SELECT fold, numbered.* FROM folds JOIN numbered ON rn < 500 + fold * 150),
  {_ridge('taught', 'fold')},
  tested AS (SELECT fold, numbered.*, k0 + k1 * x1 + k2 * x2 AS p FROM folds JOIN k USING (fold)
    JOIN numbered ON rn >= 500 + fold * 150 AND rn < 600 + fold * 150),
  scored AS (SELECT fold, {_metrics('y', 'p')}, min("timestamp") AS t0, max("timestamp") AS t1 FROM tested GROUP BY fold),
  ends AS (SELECT fold, min("timestamp") AS s0, max("timestamp") AS s1 FROM taught GROUP BY fold)
SELECT fold::BIGINT AS fold, (500 + fold * 150)::BIGINT AS train_rows, rows AS test_rows, {_iso('s0')} AS train_start,
  {_iso('s1')} AS train_end, {_iso('t0')} AS test_start, {_iso('t1')} AS test_end, mae, rmse, mape, r2
FROM scored JOIN ends USING (fold)""",
        "evaluation_report": f"""WITH {PANEL}, {two}, {_ridge('train')}, {predicted}, {_zparams(trained)}, {_robust_params(trained, 'residual')},
  s AS (SELECT 'residual_zscore' AS method, 1.5 AS threshold, {z} >= 1.5 AS flag, lbl FROM predicted, zp WHERE split = 'test'
    UNION ALL SELECT 'robust_residual', 1.25, {r} >= 1.25, lbl FROM predicted, params WHERE split = 'test'),
  c AS (SELECT method, threshold::DOUBLE AS threshold, count(*) FILTER (WHERE flag) AS detected_count, {_confusion('lbl', 'flag')}
    FROM s GROUP BY ALL)
SELECT method, threshold, detected_count, tn, fp, fn, tp, {_classify()} FROM c""",
        "tuning_report": f"""WITH {SINGLE}, {three}, {_ridge('train')}, {predicted}, {_zparams(trained)}, {_robust_params(trained, 'residual')},
  s AS (SELECT 'residual_zscore' AS method, split, {z} AS score, lbl FROM predicted, zp
    UNION ALL SELECT 'robust_residual', split, {r}, lbl FROM predicted, params),
  grid(method, i, threshold) AS (VALUES {grid}),
  cand AS (SELECT method, i, threshold::DOUBLE AS threshold, {_confusion('lbl', '(score >= threshold)')}
    FROM s JOIN grid USING (method) WHERE split = 'validation' GROUP BY ALL),
  rated AS (SELECT *, {_classify()} FROM cand),
  best AS (SELECT method, arg_max(threshold, (macro_f1, -i)) AS threshold FROM rated GROUP BY method),
  c AS (SELECT method, threshold, count(*) FILTER (WHERE score >= threshold) AS detected_count,
    {_confusion('lbl', '(score >= threshold)')} FROM s JOIN best USING (method) WHERE split = 'test' GROUP BY ALL)
SELECT method, threshold, detected_count, tn, fp, fn, tp, {_classify()} FROM c""",
        "payload_rows": f"""WITH {PANEL}, {sup}
SELECT zone, "timestamp", x1 AS load_mw, x2 AS lag_24, y AS actual_load_mw, x1 AS predicted_load_mw, true AS same
FROM sup ORDER BY zone DESC, "timestamp" DESC LIMIT 50""",
    }
    return {k: stable(v) for k, v in q.items()} | {
        "isolation_nodes": f"""WITH {PANEL},
  f AS (SELECT zone, "timestamp", temperature_c AS t, CASE WHEN solar_radiation_wm2 % 31 = 3 OR solar_radiation_wm2 % 29 = 3 THEN 50.0::DOUBLE
    ELSE load_mw END AS x FROM panel),
  s AS (SELECT zone, "timestamp", -pow(2.0::DOUBLE, -({paths})) AS v FROM f)
SELECT zone, "timestamp", {_rounded('-0.5::DOUBLE - v')} AS anomaly_score, v < -0.5 AS is_anomaly FROM s""",
    }
