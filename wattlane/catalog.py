"""Registered queries: every operator of the blueprint run over whole driver tables.

Each builder takes (spark, sf_dir) and returns a DataFrame whose columns are
aliased exactly like the matching oracle SQL in ``wattlane.oracle``.  Panels
come from ``sources.adapters`` (events as zones = event types, or one zone
'ALL').  Labels, where needed, follow the integer rule ``event_id % 50 = 0``
(the panel's solar column is ``event_id % 1000``, so the rule reads
``solar_radiation_wm2 % 50 = 0``).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.catalog_documents import QUERIES as DOCUMENT_QUERIES
from wattlane.catalog_models import QUERIES as MODEL_QUERIES
from wattlane.catalog_panels import QUERIES as PANEL_QUERIES
from wattlane.functions.jsonsafe import iso_timestamp
from wattlane.operators import detectors as det
from wattlane.operators.drift import compare_to_reference_stats, compute_reference_stats
from wattlane.operators.features import (
    FeatureConfig, add_forecast_target, add_lag_features, add_rolling_features, build_feature_frame,
    build_supervised_frame, calendar_columns,
)
from wattlane.operators.inject import inject_anomalies
from wattlane.operators.metrics import anomaly_metrics, forecast_metrics, mean_ignoring_nan
from wattlane.operators.normalize import NormalizeConfig, normalize_export
from wattlane.operators.ordering import chronological_row_number, tail_rows
from wattlane.operators.ridge import moment_columns, univariate_ridge_columns
from wattlane.operators.splits import (
    FoldSpec, assign_test_folds, fold_bounds, train_test_split, train_validation_test_split,
)
from wattlane.operators.validate import duplicate_keys, validation_report
from wattlane.plans.anomaly import residual_tuning_frame
from wattlane.sources.adapters import events_panel, raw_orders_panel, read_table
from wattlane.schema import TARGET
from wattlane.session import cut_lineage

Builder = Callable[[SparkSession, str], DataFrame]
FOLDS = FoldSpec(1000, 168, 168)
LABEL_RULE = "solar_radiation_wm2 % 50 = 0"


def _r(c: str | Column, digits: int = 6) -> Column:
    """Report rounding; a tiny offset keeps exact decimal ties (window means) off the boundary."""

    x = F.col(c) if isinstance(c, str) else c
    return F.round(x + (F.abs(x) * F.lit(1e-12) + F.lit(1e-9)), digits)


def _panel(spark: SparkSession, sf: str) -> DataFrame:
    return events_panel(spark, sf)


def _single(spark: SparkSession, sf: str) -> DataFrame:
    return events_panel(spark, sf, single_zone=True)


def _labelled(df: DataFrame) -> DataFrame:
    return df.withColumn("actual_anomaly", F.expr(LABEL_RULE))


def _naive(df: DataFrame) -> DataFrame:
    """Seasonal-naive forecast: lag 24 of the same zone; rows without it are dropped."""

    lagged = add_lag_features(df, FeatureConfig(lag_periods=(24,)))
    return lagged.where(F.col("lag_24").isNotNull()).withColumn("residual", F.col("load_mw") - F.col("lag_24"))


# ---------------------------------------------------------------- features


def calendar_features(spark: SparkSession, sf: str) -> DataFrame:
    p = _panel(spark, sf)
    cal = p.select("zone", "timestamp", *calendar_columns("timestamp"))
    return cal.select("zone", "timestamp", *[F.col(c).cast("long").alias(c) for c in ("hour", "day_of_week", "month", "is_weekend")])


def lag_features(spark: SparkSession, sf: str) -> DataFrame:
    return add_lag_features(_panel(spark, sf)).select("zone", "timestamp", "load_mw", "lag_1", "lag_24", "lag_168")


def rolling_features(spark: SparkSession, sf: str) -> DataFrame:
    r = add_rolling_features(_panel(spark, sf))
    cols = ["rolling_mean_24", "rolling_std_24", "rolling_mean_168", "rolling_std_168"]
    return r.select("zone", "timestamp", *[_r(c).alias(c) for c in cols])


def rolling_min_periods(spark: SparkSession, sf: str) -> DataFrame:
    cfg = FeatureConfig(rolling_windows=(24,), rolling_min_periods=12)
    r = add_rolling_features(_panel(spark, sf), cfg)
    return r.select("zone", "timestamp", _r("rolling_mean_24").alias("rolling_mean_24"),
                    _r("rolling_std_24").alias("rolling_std_24"))


def forecast_target(spark: SparkSession, sf: str) -> DataFrame:
    return add_forecast_target(_panel(spark, sf)).select("zone", "timestamp", "load_mw", TARGET)


FEATURE_OUT = [
    "load_mw", "temperature_c", "wind_speed_mps", "solar_radiation_wm2", "hour", "day_of_week", "month",
    "is_weekend", "lag_1", "lag_24", "lag_168", "rolling_mean_24", "rolling_std_24", "rolling_mean_168",
    "rolling_std_168", TARGET,
]


def _feature_out(df: DataFrame) -> DataFrame:
    cols = []
    for c in FEATURE_OUT:
        if c in ("hour", "day_of_week", "month", "is_weekend"):
            cols.append(F.col(c).cast("long").alias(c))
        elif c.startswith("rolling_"):
            cols.append(_r(c).alias(c))
        else:
            cols.append(F.col(c))
    return df.select("zone", "timestamp", *cols)


def feature_frame(spark: SparkSession, sf: str) -> DataFrame:
    return _feature_out(build_feature_frame(_panel(spark, sf)))


def blocked_feature_frame(spark: SparkSession, sf: str) -> DataFrame:
    """W7 through the skew-safe blocked path (blocks of 2,048 rows with halos)."""

    cfg = FeatureConfig(strategy="blocked", block_rows=2048)
    return _feature_out(build_feature_frame(_panel(spark, sf), cfg))


def global_series_features(spark: SparkSession, sf: str) -> DataFrame:
    """No zone column -> one series; the blocked path spreads it over many tasks."""

    series = _panel(spark, sf).drop("zone")
    cfg = FeatureConfig(lag_periods=(1, 24), rolling_windows=(24,), forecast_horizon=24,
                        strategy="blocked", block_rows=2048)
    f = build_feature_frame(series, cfg)
    return f.select("timestamp", "load_mw", "lag_1", "lag_24", _r("rolling_mean_24").alias("rolling_mean_24"),
                    _r("rolling_std_24").alias("rolling_std_24"), TARGET)


def _supervised(spark: SparkSession, sf: str) -> DataFrame:
    return build_supervised_frame(build_feature_frame(_panel(spark, sf))).frame


def supervised_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _supervised(spark, sf).select("zone", "timestamp", "load_mw", TARGET)


# ---------------------------------------------------------------- validation / normalisation


def _raw_events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as text columns with faults planted by integer rules on event_id."""

    ev = read_table(spark, sf, "events")
    eid = F.col("event_id")
    return ev.select(
        F.when(eid % 997 == 0, F.lit("not-a-time")).otherwise(F.col("ts").cast("string")).alias("timestamp"),
        F.when(eid % 977 == 0, F.lit("  ")).when(eid % 947 == 0, F.lit("\t")).when(eid % 971 == 0, F.lit("NA")).otherwise(F.col("event_type")).alias("zone"),
        F.when(eid % 991 == 0, F.lit("missing")).when(eid % 983 == 0, F.lit("1d"))
        .when(eid % 967 == 0, F.lit(" 5 ")).otherwise(F.col("value").cast("string")).alias("load_mw"),
        F.get_json_object("props", "$.k").alias("temperature_c"),
        (F.col("user_id") % 20).cast("string").alias("wind_speed_mps"),
        F.when(eid % 953 == 0, F.lit("inf")).otherwise((eid % 1000).cast("string")).alias("solar_radiation_wm2"),
    )


def validation_report_query(spark: SparkSession, sf: str) -> DataFrame:
    return validation_report(_raw_events(spark, sf))


def duplicate_keys_query(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_keys(raw_orders_panel(spark, sf))


def normalize_panel(spark: SparkSession, sf: str) -> DataFrame:
    ev = read_table(spark, sf, "events")
    export = ev.select(
        F.col("ts").cast("string").alias("time"),
        F.col("event_type").alias("bidding_zone"),
        F.col("value").cast("string").alias("load"),
        F.get_json_object("props", "$.k").alias("temperature"),
        (F.col("user_id") % 20).cast("string").alias("wind_speed"),
        (F.col("event_id") % 1000).cast("string").alias("solar_radiation"),
    )
    cfg = NormalizeConfig("time", "load", "temperature", "wind_speed", "solar_radiation", zone_column="bidding_zone")
    return normalize_export(export, cfg)


# ---------------------------------------------------------------- ordering and splits


def chrono_row_number(spark: SparkSession, sf: str) -> DataFrame:
    return chronological_row_number(_panel(spark, sf)).select("zone", "timestamp", "rn")


def train_test_split_query(spark: SparkSession, sf: str) -> DataFrame:
    return train_test_split(_panel(spark, sf), 0.2).frame.select("zone", "timestamp", "rn", "split")


def three_way_split(spark: SparkSession, sf: str) -> DataFrame:
    s = train_validation_test_split(_panel(spark, sf), validation_size=0.2, test_size=0.2)
    return s.frame.select("zone", "timestamp", "rn", "split")


def hash_key(ts: str = "timestamp") -> Column:
    """Integer shuffle key from wall-clock microseconds (independent of the session time zone)."""

    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")
    return ((micros % 1000003) * 7919 + 42) % 1000003


def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    s = train_test_split(_panel(spark, sf), 0.2, split_method="random", order_key=hash_key())
    return s.frame.select("zone", "timestamp", "rn", "split")


def _fold_text(df: DataFrame) -> DataFrame:
    return df.select(
        "fold", "train_rows", "test_rows",
        iso_timestamp("train_start_ts").alias("train_start"), iso_timestamp("train_end_ts").alias("train_end"),
        iso_timestamp("test_start_ts").alias("test_start"), iso_timestamp("test_end_ts").alias("test_end"),
    )


def rolling_folds(spark: SparkSession, sf: str) -> DataFrame:
    p = _single(spark, sf)
    numbered = chronological_row_number(p)
    # like the SQL, a table too short for one fold has no folds
    return _fold_text(fold_bounds(numbered, FOLDS, p.count(), strict=False))


def payload_tail(spark: SparkSession, sf: str) -> DataFrame:
    return tail_rows(_supervised(spark, sf), 3).select("zone", "timestamp", "load_mw", TARGET)


# ---------------------------------------------------------------- metrics


def _metric_out(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, "rows", *[_r(c).alias(c) for c in ("mae", "rmse", "mape", "r2")])


def forecast_metrics_naive(spark: SparkSession, sf: str) -> DataFrame:
    m = forecast_metrics(_naive(_panel(spark, sf)), "load_mw", "lag_24", by=["zone"])
    return _metric_out(m, ["zone"])


def _naive_folds(spark: SparkSession, sf: str) -> DataFrame:
    naive = chronological_row_number(_naive(_single(spark, sf)))
    n = naive.count()
    tested = assign_test_folds(naive, FOLDS, FOLDS.count(n, strict=False))
    return forecast_metrics(tested, "load_mw", "lag_24", by=["fold"])


def fold_metrics_naive(spark: SparkSession, sf: str) -> DataFrame:
    return _metric_out(_naive_folds(spark, sf).withColumn("fold", F.col("fold").cast("long")), ["fold"])


def fold_mean_naive(spark: SparkSession, sf: str) -> DataFrame:
    f = _naive_folds(spark, sf)
    return f.agg(
        F.count(F.lit(1)).alias("fold_count"),
        *[_r(mean_ignoring_nan(c)).alias(f"mean_{c}") for c in ("mae", "rmse", "mape", "r2")],
    )


def _classification_out(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, "tn", "fp", "fn", "tp", *[_r(c).alias(c) for c in ("precision", "recall", "macro_f1")])


def confusion_metrics(spark: SparkSession, sf: str) -> DataFrame:
    naive = _labelled(_naive(_panel(spark, sf)))
    scored = det.score_residuals(naive, "load_mw", "lag_24", threshold=2.0, by=["zone"])
    return _classification_out(anomaly_metrics(scored, "actual_anomaly", "is_anomaly", by=["zone"]), ["zone"])


# ---------------------------------------------------------------- detectors


def _naive_split(spark: SparkSession, sf: str):
    return train_test_split(_naive(_panel(spark, sf)), 0.2)


def _score_out(df: DataFrame) -> DataFrame:
    return df.select("zone", "timestamp", _r("anomaly_score").alias("anomaly_score"), "is_anomaly")


def residual_zscore(spark: SparkSession, sf: str) -> DataFrame:
    s = _naive_split(spark, sf)
    d = det.ResidualZScoreDetector(3.0).fit_residuals(s.part("train"), "residual")
    return _score_out(d.score_residuals(s.part("test"), "residual"))


def robust_residual(spark: SparkSession, sf: str) -> DataFrame:
    s = _naive_split(spark, sf)
    d = det.RobustResidualDetector(3.5).fit_residuals(s.part("train"), "residual")
    return _score_out(d.score_residuals(s.part("test"), "residual"))


def zone_zscore(spark: SparkSession, sf: str) -> DataFrame:
    """D3 with per-zone parameters (J5 as an equi-join on zone)."""

    s = _naive_split(spark, sf)
    d = det.ResidualZScoreDetector(3.0, by=("zone",)).fit_residuals(s.part("train"), "residual")
    return _score_out(d.score_residuals(s.part("test"), "residual"))


def robust_scale_fallback(spark: SparkSession, sf: str) -> DataFrame:
    p = _panel(spark, sf)
    load = F.col("load_mw")
    r = F.when(load < 5, load - 5).when(load > 60, load - 60).otherwise(F.lit(0.0))
    params = det.robust_parameters(p, r, by=["zone"])
    return params.select("zone", *[_r(c).alias(c) for c in ("residual_median", "raw_mad", "iqr_scale", "residual_mad")])


def residual_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Q2: naive pairs (actual = target, predicted = current load) scored by a fitted detector."""

    t = add_forecast_target(_panel(spark, sf)).where(F.col(TARGET).isNotNull())
    s = train_test_split(t, 0.2)
    d = det.ResidualZScoreDetector(3.0).fit(s.part("train"), TARGET, "load_mw")
    return _score_out(d.score(s.frame, TARGET, "load_mw"))


# ---------------------------------------------------------------- evaluation workflows


def _tuning_input(spark: SparkSession, sf: str) -> DataFrame:
    s = train_validation_test_split(_labelled(_naive(_single(spark, sf))), validation_size=0.2, test_size=0.2)
    return s.frame


def threshold_tuning(spark: SparkSession, sf: str) -> DataFrame:
    out = residual_tuning_frame(_tuning_input(spark, sf), labels=True)
    return _classification_out(out, ["method", "threshold", "detected_count"])


def no_label_defaults(spark: SparkSession, sf: str) -> DataFrame:
    out = residual_tuning_frame(_tuning_input(spark, sf).drop("actual_anomaly"), labels=False)
    return out.select("method", "threshold", "detected_count")


def method_comparison(spark: SparkSession, sf: str) -> DataFrame:
    s = train_test_split(_labelled(_naive(_panel(spark, sf))), 0.2)
    train, test = s.part("train"), s.part("test")
    z = det.ResidualZScoreDetector(3.0).fit_residuals(train, "residual").score_residuals(test, "residual")
    rb = det.RobustResidualDetector(3.5).fit_residuals(train, "residual").score_residuals(test, "residual")
    union = z.select(F.lit("residual_zscore").alias("method"), F.lit(3.0).alias("threshold"), "is_anomaly", "actual_anomaly")
    union = union.unionByName(
        rb.select(F.lit("robust_residual").alias("method"), F.lit(3.5).alias("threshold"), "is_anomaly", "actual_anomaly")
    )
    m = anomaly_metrics(union, "actual_anomaly", "is_anomaly", by=["method", "threshold"])
    counts = union.groupBy("method").agg(
        F.count_if("is_anomaly").alias("detected_count"), F.count_if("actual_anomaly").alias("labeled_anomaly_count")
    )
    return _classification_out(m.join(counts, "method"), ["method", "threshold", "detected_count", "labeled_anomaly_count"])


# ---------------------------------------------------------------- drift, injection, moments


def reference_stats(spark: SparkSession, sf: str) -> DataFrame:
    s = compute_reference_stats(_panel(spark, sf))
    return s.select("column", *[_r(c).alias(c) for c in ("count", "mean", "std", "min", "max")])


def drift_compare(spark: SparkSession, sf: str) -> DataFrame:
    p = chronological_row_number(_panel(spark, sf))
    half = p.count() // 2
    cols = ["load_mw", "temperature_c", "wind_speed_mps", "solar_radiation_wm2"]
    ref = compute_reference_stats(p.where(F.col("rn") < half), cols)
    cmp = compare_to_reference_stats(p.where(F.col("rn") >= half), ref, cols)
    return cmp.select("column", *[_r(c).alias(c) for c in cmp.columns if c != "column"])


def inject_labels(spark: SparkSession, sf: str) -> DataFrame:
    # event values are 0.01-490, so the floor is 0 (the reference's 100 MW floor suits grid loads)
    out = inject_anomalies(_single(spark, sf), 0.02, seed=42, floor=0.0)
    return out.select("zone", "timestamp", "load_mw", "is_anomaly", "anomaly_type")


MOMENT_FEATURES = ["temperature_c", "wind_speed_mps", "solar_radiation_wm2"]


def _sig(c: Column, digits: int = 9) -> Column:
    """Report rounding to significant digits (same tie offset on the mantissa as the oracle)."""

    p = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))))
    return F.when(c == 0, F.lit(0.0)).otherwise(F.round(c / p + F.lit(5e-12), digits - 1) * p)


def gram_moments(spark: SparkSession, sf: str) -> DataFrame:
    wide = _panel(spark, sf).agg(*moment_columns(MOMENT_FEATURES, "load_mw"))
    names = [c for c in wide.columns]
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in names)
    long = wide.selectExpr(f"stack({len(names)}, {pairs}) AS (name, value)")
    return long.select("name", _sig(F.col("value")).alias("value"))


def ridge_univariate(spark: SparkSession, sf: str) -> DataFrame:
    g = _panel(spark, sf).groupBy("zone").agg(*univariate_ridge_columns("temperature_c", "load_mw", 1.0))
    return g.select("zone", "rows", _r("coefficient").alias("coefficient"), _r("intercept").alias("intercept"))


def request_validation(spark: SparkSession, sf: str) -> DataFrame:
    from wattlane.plans.requests import validate_requests

    p = chronological_row_number(_panel(spark, sf))
    solar = F.col("solar_radiation_wm2")
    name = F.when(solar % 89 == 0, F.lit(" ")).otherwise(F.lit("load_mw"))
    value = F.when(solar % 97 == 0, F.lit(float("nan"))).otherwise(F.col("load_mw"))
    req_id = (F.col("rn") / 100).cast("long")
    idx = (F.col("rn") % 100).cast("long")
    actual = F.when((req_id % 7 == 3) & (idx == 0), F.lit(None).cast("double")).otherwise(F.col("load_mw"))
    req = p.select(
        req_id.alias("request_id"), idx.alias("record_idx"),
        F.create_map(name, value, F.lit("temperature_c"), F.col("temperature_c")).alias("features"),
        actual.alias("actual_load_mw"),
    )
    return validate_requests(req).select("request_id", "record_idx", "valid", "reason")


def _request_lines(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Panel rows as JSON requests of up to 100 records, with faults planted by integer rules."""

    p = chronological_row_number(_panel(spark, sf))
    solar, rn = F.col("solar_radiation_wm2").cast("long"), F.col("rn")
    load = F.when(solar % 97 == 0, F.lit("many")).otherwise(F.col("load_mw").cast("string"))
    fields = {
        "batch": [F.create_map(F.when(solar % 89 == 0, F.lit(" \t")).otherwise(F.lit("load_mw")),
                               F.when(solar % 97 != 0, F.col("load_mw")),
                               F.lit("temperature_c"), F.col("temperature_c")).alias("features"),
                  F.when(rn % 300 >= 100, F.col("load_mw")).alias("actual_load_mw")],
        "anomaly": [load.alias("actual_load_mw"), F.col("temperature_c").alias("predicted_load_mw")],
    }[kind]
    record = F.struct(*fields, F.when(solar % 83 == 0, F.lit(1)).alias("extra"))
    texts = F.sort_array(F.collect_list(F.struct("rn", F.to_json(record).alias("r"))))  # at most 100 of a request
    requests = p.groupBy(F.floor(rn / 100).alias("request_id")).agg(texts.alias("rs"))
    records = F.array_join(F.transform("rs", lambda x: x["r"]), ",")
    note = F.when(F.col("request_id") % 11 == 10, F.lit(', "note": "x"')).otherwise("")
    return requests.select(F.format_string('{"request_id": %d, "records": [%s]%s}', "request_id", records, note).alias("value"))


def request_ingest(spark: SparkSession, sf: str) -> DataFrame:
    from wattlane.plans.requests import parse_requests, validate_requests

    req = parse_requests(_request_lines(spark, sf, "batch"), "batch")
    return validate_requests(req).select("request_id", "record_idx", "valid", "reason")


def pair_validation(spark: SparkSession, sf: str) -> DataFrame:
    from wattlane.plans.requests import parse_requests, validate_pairs

    return validate_pairs(parse_requests(_request_lines(spark, sf, "anomaly"), "anomaly")).select(
        "request_id", "record_idx", "valid", "reason")


def _literal_model():
    from wattlane.operators.ridge import RidgeModel

    return RidgeModel(["load_mw", "temperature_c"], [0.5, 2.0], 1.0, {"load_mw": 10.0, "temperature_c": 4.0})


def _literal_requests(spark: SparkSession, sf: str) -> DataFrame:
    p = chronological_row_number(_panel(spark, sf))
    feats = F.map_filter(
        F.create_map(F.lit("load_mw"), F.col("load_mw"), F.lit("temperature_c"), F.col("temperature_c")),
        lambda k, v: (k == "load_mw") | (F.col("rn") % 10 != 3) & (F.floor(F.col("rn") / 100) % 9 != 8))
    return p.select(F.floor(F.col("rn") / 100).alias("request_id"), (F.col("rn") % 100).alias("record_idx"), feats.alias("features"),
                    F.when(F.floor(F.col("rn") / 100) % 3 != 1, F.col("load_mw")).alias("actual_load_mw"))


def batch_scoring(spark: SparkSession, sf: str) -> DataFrame:
    from wattlane.plans.requests import batch_predict

    detector = det.ResidualZScoreDetector(1.5, residual_mean_=1.0, residual_std_=20.0)
    out = batch_predict(_literal_requests(spark, sf), _literal_model(), detector)
    return out.select("request_id", "record_idx", _r("prediction").alias("prediction"), "error",
                      _r("anomaly_score").alias("anomaly_score"), F.coalesce("is_anomaly", F.lit(False)).alias("is_anomaly"))


# ---------------------------------------------------------------- rows-only (no SQL oracle)


def ridge_forecast(spark: SparkSession, sf: str) -> DataFrame:
    from wattlane.plans.train import TrainConfig, run_training

    res = run_training(_panel(spark, sf), TrainConfig())
    return res.scored.select("zone", "timestamp", "prediction", "anomaly_score", "is_anomaly")


def ridge_backtest(spark: SparkSession, sf: str) -> DataFrame:
    from wattlane.plans.backtest import BacktestConfig, run_backtest

    panel = _single(spark, sf)
    try:
        _, folds = run_backtest(panel, BacktestConfig())
    except ValueError as exc:  # a table too short for one fold has no folds (the library raises)
        if "Not enough supervised rows" not in str(exc):
            raise
        folds = spark.createDataFrame([], "fold BIGINT, train_rows BIGINT, test_rows BIGINT, train_start STRING, "
                                          "train_end STRING, test_start STRING, test_end STRING, mae DOUBLE, "
                                          "rmse DOUBLE, mape DOUBLE, r2 DOUBLE")
    return folds


def forest_forecast(spark: SparkSession, sf: str) -> DataFrame:
    from wattlane.operators.forest import fit_forest

    sup = build_supervised_frame(cut_lineage(build_feature_frame(_panel(spark, sf))))  # windows run once
    s = train_test_split(sup.frame, 0.2, rows=sup.rows)
    model = fit_forest(s.part("train"), sup.features, TARGET)
    return model.predict(s.part("test")).select("zone", "timestamp", TARGET, "prediction")


def isolation_scores(spark: SparkSession, sf: str) -> DataFrame:
    from wattlane.operators.isoforest import fit_isolation_forest
    from wattlane.plans.train import prepare_supervised

    sup = prepare_supervised(_panel(spark, sf), FeatureConfig())  # features cached: fit and score reuse them
    s = train_test_split(sup.frame, 0.2, rows=sup.rows)
    forest = fit_isolation_forest(s.part("train"), sup.features, rows=s.counts["train"])
    return forest.score(s.part("test")).select("zone", "timestamp", "anomaly_score", "is_anomaly")


def isolation_tuning(spark: SparkSession, sf: str) -> DataFrame:
    from wattlane.plans.anomaly import AnomalyConfig, run_anomaly_tuning

    panel = cut_lineage(inject_anomalies(_single(spark, sf), 0.02, seed=42, floor=0.0))
    out = run_anomaly_tuning(panel, AnomalyConfig(methods=("isolation_forest",)))
    rows = [(c["config"]["contamination"] if isinstance(c["config"]["contamination"], str) else str(c["config"]["contamination"]),
             c["detected_count"], c["macro_f1"]) for c in out["validation_results"]["isolation_forest"]]
    return spark.createDataFrame(rows, "contamination STRING, detected_count BIGINT, macro_f1 DOUBLE")


def anomaly_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    from wattlane.plans.anomaly import AnomalyConfig, run_anomaly_evaluation

    panel = cut_lineage(inject_anomalies(_panel(spark, sf), 0.02, seed=42, floor=0.0))
    out = run_anomaly_evaluation(panel, AnomalyConfig())
    rows = [(m, r["detected_count"], r.get("macro_f1")) for m, r in out["methods"].items()]
    return spark.createDataFrame(rows, "method STRING, detected_count BIGINT, macro_f1 DOUBLE")


def payload_json_query(spark: SparkSession, sf: str) -> DataFrame:
    from wattlane.plans.requests import payload_json, payload_records

    sup = build_supervised_frame(build_feature_frame(_panel(spark, sf)))
    return payload_json(payload_records(sup.frame, sup.features, 3))


def stream_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """Q6: request records written to the shared checkpoint folder, scored by a streaming query."""

    from wattlane.session import ensure_checkpoint_dir
    from wattlane.streaming.scoring import run_stream_scoring

    detector = det.ResidualZScoreDetector(1.5, residual_mean_=1.0, residual_std_=20.0)
    root = os.path.join(ensure_checkpoint_dir(spark), f"stream-{uuid.uuid4().hex}")
    _literal_requests(spark, sf).write.parquet(f"{root}/source")
    q = run_stream_scoring(spark, f"{root}/source", f"{root}/sink", f"{root}/checkpoint", _literal_model(), detector)
    q.awaitTermination()
    return spark.read.parquet(f"{root}/sink").select(
        "request_id", "record_idx", _r("prediction").alias("prediction"), "error",
        _r("anomaly_score").alias("anomaly_score"), F.coalesce("is_anomaly", F.lit(False)).alias("is_anomaly"))


# ---------------------------------------------------------------- registry

ORACLE_QUERIES: dict[str, Builder] = {
    "calendar_features": calendar_features,
    "lag_features": lag_features,
    "rolling_features": rolling_features,
    "rolling_min_periods": rolling_min_periods,
    "forecast_target": forecast_target,
    "feature_frame": feature_frame,
    "blocked_feature_frame": blocked_feature_frame,
    "global_series_features": global_series_features,
    "supervised_rows": supervised_rows,
    "validation_report": validation_report_query,
    "duplicate_keys": duplicate_keys_query,
    "normalize_panel": normalize_panel,
    "chrono_row_number": chrono_row_number,
    "train_test_split": train_test_split_query,
    "three_way_split": three_way_split,
    "hash_split": hash_split,
    "rolling_folds": rolling_folds,
    "payload_tail": payload_tail,
    "forecast_metrics_naive": forecast_metrics_naive,
    "fold_metrics_naive": fold_metrics_naive,
    "fold_mean_naive": fold_mean_naive,
    "confusion_metrics": confusion_metrics,
    "residual_zscore": residual_zscore,
    "robust_residual": robust_residual,
    "zone_zscore": zone_zscore,
    "robust_scale_fallback": robust_scale_fallback,
    "residual_pairs": residual_pairs,
    "threshold_tuning": threshold_tuning,
    "no_label_defaults": no_label_defaults,
    "method_comparison": method_comparison,
    "reference_stats": reference_stats,
    "drift_compare": drift_compare,
    "inject_labels": inject_labels,
    "gram_moments": gram_moments,
    "ridge_univariate": ridge_univariate,
    "request_validation": request_validation,
    "request_ingest": request_ingest,
    "pair_validation": pair_validation,
    "batch_scoring": batch_scoring,
    "stream_scoring": stream_scoring,
}

ROWS_ONLY: dict[str, Builder] = {
    "ridge_forecast": ridge_forecast,
    "ridge_backtest": ridge_backtest,
    "forest_forecast": forest_forecast,
    "isolation_scores": isolation_scores,
    "isolation_tuning": isolation_tuning,
    "anomaly_evaluation": anomaly_evaluation,
    "payload_json": payload_json_query,
}

QUERIES: dict[str, Builder] = {**ORACLE_QUERIES, **ROWS_ONLY}


# ---------------------------------------------------------------- other adapters


def event_hours_dense(spark: SparkSession, sf: str) -> DataFrame:
    """AD2 + spine densification: hourly event aggregates per type with gaps filled as NULL rows."""

    from wattlane.sources.adapters import densify, event_hours_panel

    dense = densify(event_hours_panel(spark, sf), "1 hour")
    return dense.select("zone", "timestamp", _r("load_mw").alias("load_mw"), _r("temperature_c").alias("temperature_c"),
                        F.col("wind_speed_mps").alias("events"))


def supplier_day_features(spark: SparkSession, sf: str) -> DataFrame:
    """AD4: many zones (one per supplier); daily lags and a weekly rolling mean."""

    from wattlane.sources.adapters import supplier_days_panel

    cfg = FeatureConfig(lag_periods=(1, 7), rolling_windows=(7,), forecast_horizon=1)
    f = build_feature_frame(supplier_days_panel(spark, sf), cfg)
    # money-scale values (~1e5): cents, not 6 decimals (11+ significant digits exceed summation-order noise)
    return f.select("zone", "timestamp", *[_r(c, 2).alias(c) for c in ("load_mw", "lag_1", "lag_7", "rolling_mean_7", TARGET)])


def order_day_naive_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """AD3: daily order value per priority, weekly-naive (lag 7) forecast metrics per zone."""

    from wattlane.sources.adapters import order_days_panel

    lagged = add_lag_features(order_days_panel(spark, sf), FeatureConfig(lag_periods=(7,)))
    m = forecast_metrics(lagged.where(F.col("lag_7").isNotNull()), "load_mw", "lag_7", by=["zone"])
    # errors are money-scale (~1e5): ten significant digits
    return m.select("zone", "rows", _sig(F.col("mae"), 10).alias("mae"), _sig(F.col("rmse"), 10).alias("rmse"),
                    _r("mape").alias("mape"), _r("r2").alias("r2"))


ORACLE_QUERIES.update({
    "event_hours_dense": event_hours_dense,
    "supplier_day_features": supplier_day_features,
    "order_day_naive_metrics": order_day_naive_metrics,
})
QUERIES.update(ORACLE_QUERIES)
QUERIES.update(ROWS_ONLY)


def zone_ridge_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """M3 per zone: every zone's ridge from one grouped moment aggregate (rows-only)."""

    from wattlane.operators.ridge import fit_ridge_by

    sup = build_supervised_frame(build_feature_frame(_panel(spark, sf)))
    s = train_test_split(sup.frame, 0.2, rows=sup.rows)
    model = fit_ridge_by(s.part("train"), sup.features, TARGET, ["zone"], center=sup.means)
    return model.predict(s.part("test")).select("zone", "timestamp", TARGET, "prediction")


ROWS_ONLY["zone_ridge_forecast"] = zone_ridge_forecast
QUERIES["zone_ridge_forecast"] = zone_ridge_forecast

# ---------------------------------------------------------------- queries of the other modules

for more in (DOCUMENT_QUERIES, PANEL_QUERIES, MODEL_QUERIES):
    ORACLE_QUERIES.update(more)
    QUERIES.update(more)
