import json
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SMOKE, make_panel
from wattlane.functions.jsonsafe import iso_timestamp, json_safe
from wattlane.operators.drift import compare_to_reference_stats, compute_reference_stats
from wattlane.operators.inject import inject_anomalies
from wattlane.operators.ridge import fit_ridge
from wattlane.operators.detectors import ResidualZScoreDetector
from wattlane.plans.requests import batch_predict, forecast_requests, validate_requests
from wattlane.session import ensure_checkpoint_dir
from wattlane.sources.adapters import events_panel
from wattlane.sources.sinks import read_json_metrics, write_json_metrics
from wattlane.streaming.scoring import run_stream_scoring, score_stream


def test_reference_stats_and_drift(spark):
    p = events_panel(spark, SMOKE)
    stats = compute_reference_stats(p).toPandas().set_index("column")
    pdf = p.toPandas()
    assert stats.loc["load_mw", "mean"] == pytest.approx(pdf["load_mw"].mean())
    assert stats.loc["load_mw", "std"] == pytest.approx(pdf["load_mw"].std(ddof=0))
    cmp = compare_to_reference_stats(p, compute_reference_stats(p)).toPandas()
    assert np.allclose(cmp["mean_delta"], 0.0)


def test_injection_counts_types_and_determinism(spark):
    p = events_panel(spark, SMOKE, single_zone=True)
    a = inject_anomalies(p, 0.02, seed=42, floor=0.0).toPandas().sort_values("timestamp")
    b = inject_anomalies(p.repartition(3), 0.02, seed=42, floor=0.0).toPandas().sort_values("timestamp")
    pd.testing.assert_frame_equal(a.reset_index(drop=True), b.reset_index(drop=True))
    assert set(a["anomaly_type"]) <= {"normal", "spike", "drop", "level_shift"}
    anchors = 20  # round(1000 * 0.02)
    spikes_drops = ((a["anomaly_type"] == "spike") | (a["anomaly_type"] == "drop")).sum()
    assert 1 <= a["is_anomaly"].sum() <= anchors * 6 and spikes_drops <= anchors
    orig = p.toPandas().sort_values("timestamp")
    unchanged = ~a["is_anomaly"].to_numpy()
    assert np.allclose(a["load_mw"].to_numpy()[unchanged], orig["load_mw"].round(3).to_numpy()[unchanged])


def test_iso_timestamp_text(spark):
    df = spark.createDataFrame([(pd.Timestamp("2026-01-01 01:02:03").to_pydatetime(),), (pd.Timestamp("2026-01-01 01:02:03.000500").to_pydatetime(),)],
                               "t TIMESTAMP_NTZ")
    assert [r[0] for r in df.select(iso_timestamp("t")).collect()] == ["2026-01-01T01:02:03", "2026-01-01T01:02:03.000500"]


def test_json_metrics_sink(spark, tmp_path):
    path = str(tmp_path / "m")
    write_json_metrics(spark, {"b": float("nan"), "a": np.float64(1.5), "c": [np.int64(2), float("inf")]}, path)
    assert read_json_metrics(spark, path) == {"a": 1.5, "b": None, "c": [2, None]}
    assert json_safe({"x": (1, float("-inf"))}) == {"x": [1, None]}


def _model(spark):
    df = spark.createDataFrame([(float(i), float(i % 3), 2.0 * i + 1) for i in range(20)], "a DOUBLE, b DOUBLE, y DOUBLE")
    return fit_ridge(df, ["a", "b"], "y")


def test_request_validation_and_forecast(spark):
    m = _model(spark)
    req = spark.createDataFrame([
        (1, 0, {"a": 1.0, "b": 2.0}, None), (1, 1, {"a": 2.0}, None),          # b imputed for record 1
        (2, 0, {"a": 1.0}, None),                                             # b missing in whole request
        (3, 0, {" ": 1.0}, None), (3, 1, {"a": float("nan")}, None),
        (4, 0, {"a": 1.0, "b": 1.0}, 3.0), (4, 1, {"a": 1.0, "b": 1.0}, None),  # partial actuals
    ], "request_id BIGINT, record_idx BIGINT, features MAP<STRING,DOUBLE>, actual_load_mw DOUBLE")
    v = {(r["request_id"], r["record_idx"]): r["reason"] for r in validate_requests(req).collect()}
    assert v[(1, 0)] is None and v[(3, 0)] == "blank_feature_name" and v[(3, 1)] == "non_finite_feature"
    assert v[(4, 0)] == "partial_actuals"
    f = {(r["request_id"], r["record_idx"]): r for r in forecast_requests(req, m).collect()}
    assert f[(2, 0)]["prediction"] is None and "b" in f[(2, 0)]["error"]
    full = m.predict(spark.createDataFrame([(2.0, m.medians["b"])], "a DOUBLE, b DOUBLE")).first()["prediction"]
    assert f[(1, 1)]["prediction"] == pytest.approx(full)
    det = ResidualZScoreDetector(3.0, residual_mean_=0.0, residual_std_=1.0)
    out = {(r["request_id"], r["record_idx"]): r for r in batch_predict(req, m, det).collect()}
    assert out[(4, 0)]["error"].startswith("actual_load_mw must be provided")


def test_stream_scoring_equals_batch(spark):
    m = _model(spark)
    det = ResidualZScoreDetector(3.0, residual_mean_=0.0, residual_std_=2.0)
    rows = [(0, i, {"a": float(i), "b": float(i % 2)}, float(2 * i + 1)) for i in range(30)]
    req = spark.createDataFrame(rows, "request_id BIGINT, record_idx BIGINT, features MAP<STRING,DOUBLE>, actual_load_mw DOUBLE")
    root = os.path.join(ensure_checkpoint_dir(spark), "stream-test")
    req.write.mode("overwrite").parquet(f"{root}/src")
    q = run_stream_scoring(spark, f"{root}/src", f"{root}/sink", f"{root}/ckpt", m, det)
    q.awaitTermination()
    streamed = spark.read.parquet(f"{root}/sink").orderBy("record_idx").toPandas()
    batch = score_stream(req, m, det).orderBy("record_idx").toPandas()
    assert len(streamed) == 30
    assert np.allclose(streamed["prediction"], batch["prediction"])
    assert list(streamed["is_anomaly"]) == list(batch["is_anomaly"])


def test_detector_and_forest_persistence(spark, tmp_path):
    from wattlane.operators.isoforest import fit_isolation_forest
    from wattlane.sources.artifacts import load_detector, save_detector

    df = spark.createDataFrame([(float(i), float(i % 5), "a" if i % 2 else "b") for i in range(50)], "x DOUBLE, r DOUBLE, zone STRING")
    for det in (ResidualZScoreDetector(2.0).fit_residuals(df, "r"),
                ResidualZScoreDetector(2.0, by=("zone",)).fit_residuals(df, "r")):
        path = str(tmp_path / f"det{len(det.by)}")
        save_detector(spark, det, path)
        back = load_detector(spark, path)
        a = det.score_residuals(df, "r").orderBy("x").toPandas()
        b = back.score_residuals(df, "r").orderBy("x").toPandas()
        assert np.allclose(a["anomaly_score"], b["anomaly_score"])
    forest = fit_isolation_forest(df, ["x", "r"], contamination=0.1)
    save_detector(spark, forest, str(tmp_path / "forest"))
    back = load_detector(spark, str(tmp_path / "forest"))
    a = forest.score(df).orderBy("x").toPandas()
    b = back.score(df).orderBy("x").toPandas()
    assert np.allclose(a["anomaly_score"], b["anomaly_score"]) and back.offset == forest.offset


def test_normalize_file_roundtrip(spark, tmp_path):
    from wattlane.operators.normalize import NormalizeConfig
    from wattlane.sources.artifacts import normalize_export_file

    src = tmp_path / "export.csv"
    src.write_text("time,load,temperature,wind_speed,solar_radiation\n"
                   "2026-01-01 02:00,930,5,6,0\n2026-01-01 00:00,900,4.8,5.5,0\n2026-01-01 01:00,915,4.9,5.8,0\n")
    out = str(tmp_path / "canonical")
    cfg = NormalizeConfig("time", "load", "temperature", "wind_speed", "solar_radiation", zone_value="DE")
    normalize_export_file(spark, str(src), out, cfg)
    back = spark.read.option("header", True).csv(out).toPandas()
    assert list(back.columns) == ["timestamp", "zone", "load_mw", "temperature_c", "wind_speed_mps", "solar_radiation_wm2"]
    assert len(back) == 3


def test_densify_chunks_equal_single_sequence(spark):
    from wattlane.sources.adapters import densify, event_hours_panel

    hours = event_hours_panel(spark, SMOKE)
    a = densify(hours, "1 hour").toPandas().sort_values(["zone", "timestamp"]).reset_index(drop=True)
    b = densify(hours, "1 hour", chunk_steps=7).toPandas().sort_values(["zone", "timestamp"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b)
    spans = hours.toPandas().groupby("zone")["timestamp"].agg(["min", "max"])
    expected = int(((spans["max"] - spans["min"]) / pd.Timedelta(hours=1) + 1).sum())
    assert len(a) == expected


def test_stream_restart_is_exactly_once(spark):
    m = _model(spark)
    schema = "request_id BIGINT, record_idx BIGINT, features MAP<STRING,DOUBLE>, actual_load_mw DOUBLE"
    root = os.path.join(ensure_checkpoint_dir(spark), "stream-restart")
    first = spark.createDataFrame([(1, i, {"a": float(i), "b": 1.0}, None) for i in range(10)], schema)
    first.write.mode("overwrite").parquet(f"{root}/src")
    run_stream_scoring(spark, f"{root}/src", f"{root}/sink", f"{root}/ckpt", m).awaitTermination()
    again = run_stream_scoring(spark, f"{root}/src", f"{root}/sink", f"{root}/ckpt", m)  # nothing new
    again.awaitTermination()
    assert spark.read.parquet(f"{root}/sink").count() == 10
    more = spark.createDataFrame([(2, i, {"a": float(i), "b": 2.0}, None) for i in range(5)], schema)
    more.write.mode("append").parquet(f"{root}/src")
    run_stream_scoring(spark, f"{root}/src", f"{root}/sink", f"{root}/ckpt", m).awaitTermination()
    out = spark.read.parquet(f"{root}/sink")
    assert out.count() == 15 and out.select("request_id", "record_idx").distinct().count() == 15
