
import pytest

from golden import demo_frame, demo_panel
from wattlane.plans.anomaly import AnomalyConfig, run_anomaly_evaluation, run_anomaly_tuning
from wattlane.plans.backtest import BacktestConfig, run_backtest
from wattlane.plans.train import TrainConfig, run_training


@pytest.fixture(scope="module")
def demo(spark):
    return demo_panel(spark).cache()


def test_fixture_shape():
    f = demo_frame()
    assert len(f) == 2160 and f["is_anomaly"].sum() > 0
    assert set(f["anomaly_type"]) <= {"normal", "spike", "drop", "level_shift"}


def test_golden_forecast_split(demo):
    r = run_training(demo, TrainConfig())
    assert r.forecast["row_counts"] == {"train": 1574, "test": 394}
    m = r.forecast["metrics"]
    assert (round(m["mae"], 4), round(m["rmse"], 4), round(m["mape"], 4), round(m["r2"], 4)) == (49.7463, 89.4063, 4.7236, 0.2259)
    assert r.anomaly["anomalies_detected"] == 5
    assert r.anomaly["labeled_metrics"]["confusion_matrix"] == [[366, 5], [23, 0]]
    assert len(r.supervised.features) == 15


def test_backtest_purge_changes_training_rows(demo):
    out, folds = run_backtest(demo, BacktestConfig(purge=24))
    first = folds.orderBy("fold").first()
    assert first["train_rows"] == 1000 - 24 and first["test_rows"] == 168
    assert out["aggregate_metrics"]["fold_count"] == 5


def test_golden_backtest(spark, demo, tmp_path):
    from wattlane.sources.sinks import read_json_metrics

    out, _ = run_backtest(demo, BacktestConfig(), metrics_dir=str(tmp_path))
    assert read_json_metrics(spark, str(tmp_path / "backtest_ridge_h24"))["aggregate_metrics"]["fold_count"] == 5
    folds = spark.read.json(str(tmp_path / "backtest_ridge_h24_folds"))
    assert sorted(r.train_rows for r in folds.collect()) == [1000 + 168 * k for k in range(5)]
    assert folds.select("metrics.mae").count() == 5
    a = out["aggregate_metrics"]
    assert a["fold_count"] == 5
    assert (round(a["mean_mae"], 4), round(a["mean_rmse"], 4), round(a["mean_mape"], 4), round(a["mean_r2"], 4)) == (
        46.1106, 65.7001, 4.5168, 0.3317)


def test_golden_tuning(demo):
    out = run_anomaly_tuning(demo, AnomalyConfig(methods=("residual_zscore", "robust_residual")))
    assert out["row_counts"] == {"train": 1180, "validation": 394, "test": 394}
    sel = out["selected_config_by_method"]
    assert sel["residual_zscore"]["threshold"] == 1.5 and sel["robust_residual"]["threshold"] == 2.0
    t = out["test_results_by_method"]
    assert t["residual_zscore"]["confusion_matrix"] == [[353, 18], [23, 0]]
    assert t["robust_residual"]["confusion_matrix"] == [[346, 25], [23, 0]]


def test_golden_comparison(demo):
    out = run_anomaly_evaluation(demo, AnomalyConfig(methods=("residual_zscore", "robust_residual")))
    assert out["methods"]["residual_zscore"]["confusion_matrix"] == [[366, 5], [23, 0]]
    assert out["methods"]["robust_residual"]["confusion_matrix"] == [[362, 9], [23, 0]]


def test_no_labels_use_defaults(demo):
    out = run_anomaly_tuning(demo.drop("is_anomaly", "anomaly_type"),
                             AnomalyConfig(methods=("residual_zscore", "robust_residual")))
    assert out["selection_metric"] == "default_configuration"
    assert out["selected_config_by_method"]["residual_zscore"]["threshold"] == 3.0
    assert out["selected_config_by_method"]["robust_residual"]["threshold"] == 3.5
    assert out["test_results_by_method"]["residual_zscore"]["macro_f1"] is None


def test_multi_zone_rejected(spark, demo):
    from pyspark.sql import functions as F
    two = demo.unionByName(demo.withColumn("zone", F.lit("OTHER")))
    with pytest.raises(ValueError, match="exactly one zone"):
        run_backtest(two, BacktestConfig())


def test_one_pass_folds_equal_direct_fits(spark):
    """Property: prefix-summed block moments give the same coefficients as refitting each fold."""
    import numpy as np

    from wattlane.operators.features import FeatureConfig, build_feature_frame, build_supervised_frame
    from wattlane.operators.ordering import chronological_row_number
    from wattlane.operators.ridge import fit_ridge
    from wattlane.operators.splits import FoldSpec
    from wattlane.plans.backtest import ridge_fold_coefficients
    from wattlane.sources.adapters import events_panel

    panel = events_panel(spark, "/root/testdata/sf0.001", single_zone=True)
    sup = build_supervised_frame(build_feature_frame(panel, FeatureConfig(forecast_horizon=3)))
    numbered = chronological_row_number(sup.frame).cache()
    spec = FoldSpec(300, 50, 40)
    count = spec.count(sup.rows)
    for purge in (0, 3):
        one_pass = ridge_fold_coefficients(numbered, sup.features, "target_load_mw", spec, count, 1.0, purge=purge).orderBy("fold").collect()
        for fold, intercept, *coef in one_pass[:: max(1, count // 4)]:
            rows = numbered.where(numbered.rn < spec.cut(fold) - purge)
            direct = fit_ridge(rows, sup.features, "target_load_mw", impute=False)
            assert np.allclose(coef, direct.coefficients, rtol=1e-8, atol=1e-10)
            assert abs(intercept - direct.intercept) < 1e-7 * max(1.0, abs(direct.intercept))


def test_aligned_labels_lift_recall(demo):
    """SURVEY 7.5.1: leading the label by h pairs it with the residual it explains."""
    base = run_anomaly_tuning(demo, AnomalyConfig(methods=("residual_zscore",)))
    aligned = run_anomaly_tuning(demo, AnomalyConfig(methods=("residual_zscore",), align_labels="target"))
    assert base["test_results_by_method"]["residual_zscore"]["recall"] == 0.0
    assert aligned["test_results_by_method"]["residual_zscore"]["recall"] > 0.3


def test_purge_gap(spark):
    from wattlane.operators.splits import train_test_split
    from wattlane.sources.adapters import events_panel

    s = train_test_split(events_panel(spark, "/root/testdata/sf0.001"), 0.2, purge=24)
    assert s.counts == {"train": 776, "test": 200, "purged": 24}
    got = {r["split"]: r["count"] for r in s.frame.groupBy("split").count().collect()}
    assert got == {"train": 776, "test": 200, "purged": 24}
