"""Inputs on which earlier versions gave wrong answers, against numpy or the documented formula."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wattlane.operators.detectors import score_robust_residuals
from wattlane.operators.drift import compute_reference_stats
from wattlane.operators.features import build_supervised_frame
from wattlane.operators.isoforest import _distinct_positions, fit_isolation_forest
from wattlane.operators.metrics import anomaly_metrics, forecast_metrics
from wattlane.operators.quantiles import column_medians, exact_quantiles
from wattlane.operators.ridge import RidgeModel, fit_ridge
from wattlane.operators.validate import ReadOptions, quarantine, validation_report
from wattlane.plans.requests import REQUEST_SCHEMA, batch_predict, payload_json

RESIDUALS = np.array([0.0, 1, 2, 3, 4, 5, 6, 40.0])


def _robust(spark, **given):
    df = spark.createDataFrame([(float(r), 0.0) for r in RESIDUALS], "a DOUBLE, p DOUBLE")
    return [r["anomaly_score"] for r in score_robust_residuals(df, "a", "p", **given).collect()]


def _robust_numpy(median=None, mad=None):
    center = np.median(RESIDUALS) if median is None else median
    scale = np.median(np.abs(RESIDUALS - center)) if mad is None else mad
    if not np.isfinite(scale) or scale == 0:
        q75, q25 = np.percentile(RESIDUALS, [75, 25])
        scale = (q75 - q25) / 1.349
    return np.abs(0.6745 * (RESIDUALS - center) / scale)


@pytest.mark.parametrize("median, mad", [(None, None), (10.0, None), (None, 4.0), (10.0, 4.0), (None, 0.0), (3.0, float("inf"))])
def test_robust_scores_use_what_is_given(spark, median, mad):
    got = _robust(spark, residual_median=median, residual_mad=mad)
    assert np.allclose(got, _robust_numpy(median, mad), atol=1e-9)
    by = spark.createDataFrame([(g, float(r), 0.0) for g in "xy" for r in RESIDUALS], "g STRING, a DOUBLE, p DOUBLE")
    scored = score_robust_residuals(by, "a", "p", residual_median=median, residual_mad=mad, by=["g"])
    for g in "xy":
        rows = scored.where(F.col("g") == g).orderBy("a").collect()
        assert np.allclose([r["anomaly_score"] for r in rows], _robust_numpy(median, mad), atol=1e-9)


def test_nan_is_missing_in_supervised_rows(spark):
    rows = [(float(i), float("nan") if i < 5 else 2.0 * i, float("nan"), float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, void DOUBLE, target_load_mw DOUBLE")
    sup = build_supervised_frame(df)
    assert sup.features == ["a", "b"] and sup.rows == sup.frame.count() == 5
    assert sup.means["b"] == pytest.approx(np.mean([2.0 * i for i in range(5, 10)]))


def test_ridge_imputes_medians_before_the_fit(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 2))
    y = 2 * x[:, 0] - 0.6 * x[:, 1] + rng.normal(size=60) * 0.1
    x[::7, 0] = np.nan
    pdf = pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": y})
    df = spark.createDataFrame(pdf).withColumn("a", F.when(~F.isnan("a"), F.col("a")))
    model = fit_ridge(df, ["a", "b"], "y")
    filled = np.where(np.isnan(x), np.nanmedian(x, axis=0), x)
    z = (filled - filled.mean(axis=0)) / filled.std(axis=0)
    w = np.linalg.solve(z.T @ z + np.eye(2), z.T @ (y - y.mean())) / filled.std(axis=0)
    assert np.allclose(model.coefficients, w, atol=1e-9)
    assert model.medians == {"a": pytest.approx(np.nanmedian(x[:, 0])), "b": pytest.approx(np.median(x[:, 1]))}


def _requests(spark, rows):
    return spark.createDataFrame(rows, REQUEST_SCHEMA)


def test_batch_predict_keeps_repeated_records_and_needs_a_detector(spark):
    model = RidgeModel(["a"], [2.0], 1.0)
    req = _requests(spark, [(1, 0, {"a": 1.0}, 3.0), (1, 0, {"a": 2.0}, 4.0), (2, 0, {"a": 1.0}, None)])
    out = batch_predict(req, model).collect()
    assert len(out) == 3
    assert {r.error for r in out if r.request_id == 1} == {"Anomaly detector is not available."}
    assert [r.error for r in out if r.request_id == 2] == [None]


def test_payload_refuses_features_that_are_not_finite(spark):
    rows = [("z", {"a": float("nan")}, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "zone STRING, features MAP<STRING,DOUBLE>, actual_load_mw DOUBLE, predicted_load_mw DOUBLE")
    with pytest.raises(Exception, match="Feature value must be finite: a"):
        payload_json(df.withColumn("timestamp", F.lit("t"))).collect()


def test_a_tab_is_a_blank_zone_and_duplicates_are_quarantined(spark):
    rows = [("2026-01-01", "\t", "1"), ("2026-01-02", " ", "1"), ("2026-01-03", "z", "1"), ("2026-01-03", "z", "2")]
    df = spark.createDataFrame(rows, "timestamp STRING, zone STRING, load_mw STRING")
    opts = ReadOptions(required_columns=("timestamp", "zone", "load_mw"), numeric_columns=("load_mw",))
    report = {r.rule: r.violations for r in validation_report(df, opts).collect()}
    assert report["blank_zone"] == 2 and report["duplicate_keys"] == 1
    good, bad = quarantine(df, opts)
    assert good.count() == 1
    assert sorted(r.reason for r in bad.collect()) == ["blank_zone", "blank_zone", "duplicate_keys"]


def test_reference_stats_coerce_text(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), (" 3 ",)], "v STRING")
    (r,) = compute_reference_stats(df, ["v"]).collect()
    assert (r["count"], r["mean"]) == (2.0, 2.0)


def test_metrics_of_unknown_flags_and_of_no_rows(spark):
    df = spark.createDataFrame([(True, None), (None, True), (True, True)], "l BOOLEAN, p BOOLEAN")
    m = anomaly_metrics(df, "l", "p").first()
    assert (m.tn, m.fp, m.fn, m.tp) == (0, 1, 1, 1)
    for empty in (lambda: anomaly_metrics(df.limit(0), "l", "p").collect(),
                  lambda: forecast_metrics(spark.createDataFrame([], "a DOUBLE, p DOUBLE"), "a", "p").collect()):
        with pytest.raises(Exception, match="must not be empty"):
            empty()
    assert anomaly_metrics(df.limit(0).withColumn("g", F.lit(1)), "l", "p", by=["g"]).count() == 0


def test_quantiles_narrow_their_brackets(spark):
    rng = np.random.default_rng(2)
    values = np.concatenate([rng.normal(size=60_000), np.zeros(30_000), [1e300, -1e300]])
    df = spark.createDataFrame(pd.DataFrame({"v": values, "g": np.arange(len(values)) % 2}))
    probs = [0.0, 0.1, 0.25, 0.5, 0.5001, 0.9, 0.999, 1.0]
    want = np.percentile(values, [100 * p for p in probs])
    narrow = exact_quantiles(df, "v", probs, accuracy=200, candidates=50)  # takes several rounds
    assert np.allclose(narrow.first(), want, rtol=1e-12, atol=1e-12)
    assert np.allclose(exact_quantiles(df, "v", probs).first(), want, rtol=1e-12, atol=1e-12)
    by = exact_quantiles(df, "v", probs, by=["g"], accuracy=200, candidates=50).orderBy("g").collect()
    for g in (0, 1):
        assert np.allclose(list(by[g])[1:], np.percentile(values[g::2], [100 * p for p in probs]), rtol=1e-12, atol=1e-12)


def test_ungrouped_quantiles_shuffle_no_raw_values(spark):
    df = spark.range(0, 50_000, 1, 8).select((F.col("id") * 1.0).alias("v"), (F.col("id") % 7 * 1.0).alias("w"))
    assert column_medians(df, ["v", "w"]) == {"v": 24999.5, "w": 3.0}
    sc = spark.sparkContext
    assert exact_quantiles(df, "v", [0.5]).first()[0] == 24999.5 and sc is not None


def test_isolation_trees_draw_from_the_whole_table(spark):
    n = 100_000
    drawn = np.concatenate([_distinct_positions(np.random.default_rng(s), n, 256) for s in range(40)])
    assert np.bincount(drawn // 10_000, minlength=10).min() > 0.7 * len(drawn) / 10
    df = spark.range(n).select((F.col("id") * 1.0).alias("x"), F.col("id").alias("rn"))
    forest = fit_isolation_forest(df, ["x"], trees=20, rows=n)
    cuts = forest.nodes.loc[forest.nodes["feature"] >= 0, "threshold"]
    assert cuts.min() < 0.02 * n and cuts.max() > 0.98 * n
    same = fit_isolation_forest(df, ["x"], trees=20, rows=n)
    assert same.nodes.equals(forest.nodes)


def test_forest_and_training_artefacts_load_again(spark, tmp_path):
    from golden import demo_panel

    from wattlane.operators.forest import ForestModel, fit_forest
    from wattlane.plans.train import TrainConfig, run_training
    from wattlane.sources.artifacts import load_detector

    df = spark.createDataFrame([(float(i), float(i % 5), 3.0 * i) for i in range(80)], "a DOUBLE, b DOUBLE, y DOUBLE")
    model = fit_forest(df, ["a", "b"], "y", num_trees=5)
    model.save(str(tmp_path / "forest"))
    again = ForestModel.load(spark, str(tmp_path / "forest"))
    assert again.feature_names == ["a", "b"] and again.medians == model.medians
    assert again.predict(df).collect() == model.predict(df).collect()

    run = run_training(demo_panel(spark), TrainConfig(), model_dir=str(tmp_path))
    ridge = RidgeModel.load(spark, str(tmp_path / "forecast_ridge_h24"))
    assert ridge.coefficients == run.model.coefficients
    assert load_detector(spark, str(tmp_path / "anomaly_residual_zscore")).residual_mean_ == run.detector.residual_mean_


def test_numbering_survives_a_cleared_cache(spark):
    from wattlane.operators.ordering import row_number

    df = spark.range(0, 20_000, 1, 7).select(F.xxhash64("id").alias("k"))
    numbered = row_number(df, ["k"])
    spark.catalog.clearCache()
    rows = numbered.orderBy("k").collect()
    assert [r.rn for r in rows] == list(range(20_000))


def test_json_requests_are_parsed_and_refused_with_a_reason(spark):
    from wattlane.plans.requests import parse_requests, validate_pairs, validate_requests

    docs = [
        '{"request_id": 1, "records": [{"features": {"a": 1.5}}, {"features": {"a": 2}, "actual_load_mw": 3}]}',
        '{"request_id": 2, "records": [{"features": {"a": 1}, "surplus": 1}]}',
        '{"request_id": 3, "records": [], "note": "x"}', '{"request_id": 4, "records": []}', "no json",
        '{"request_id": 5, "records": [{"features": {"a": "x"}}]}', '{"request_id": 6, "records": [{}]}',
    ]
    lines = spark.createDataFrame([(d,) for d in docs], "value STRING")
    got = {(r.request_id, r.record_idx): r.reason for r in validate_requests(parse_requests(lines, "batch")).collect()}
    assert got[1, 0] == got[1, 1] == "partial_actuals"
    assert (got[2, 0], got[3, 0], got[4, 0]) == ("unknown_field", "unknown_field", "no_records")
    assert got[None, 0] == "malformed" and got[6, 0] == "malformed"
    assert got[5, 0] in ("malformed", "non_finite_feature")
    pairs = ['{"request_id": 1, "records": [{"actual_load_mw": 1, "predicted_load_mw": 2}, {"actual_load_mw": 1}]}']
    parsed = parse_requests(spark.createDataFrame([(d,) for d in pairs], "value STRING"), "anomaly")
    assert [r.reason for r in validate_pairs(parsed).orderBy("record_idx").collect()] == [None, "non_finite_load"]


def test_checkpoint_folder_is_needed_off_local_mode(spark, monkeypatch):
    from types import SimpleNamespace

    from wattlane.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda *a: None)
    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: conf)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=context))
