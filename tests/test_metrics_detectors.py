import numpy as np
import pandas as pd
import pytest

from wattlane.operators.detectors import (
    ResidualZScoreDetector, RobustResidualDetector, score_residuals, score_robust_residuals,
)
from wattlane.operators.metrics import anomaly_metrics, forecast_metrics
from wattlane.operators.quantiles import exact_quantiles


def pairs(spark, actual, predicted):
    return spark.createDataFrame(list(zip(map(float, actual), map(float, predicted))), "a DOUBLE, p DOUBLE")


def test_perfect_forecast(spark):
    m = forecast_metrics(pairs(spark, [1, 2, 4], [1, 2, 4]), "a", "p").first()
    assert (m["mae"], m["rmse"], m["mape"], m["r2"]) == (0.0, 0.0, 0.0, 1.0)


def test_forecast_metrics_match_formulas(spark):
    y, p = np.array([3.0, 0.0, 5.0, 2.0]), np.array([2.5, 0.5, 4.0, 3.0])
    m = forecast_metrics(pairs(spark, y, p), "a", "p").first()
    e = y - p
    assert m["mae"] == pytest.approx(np.mean(np.abs(e)))
    assert m["rmse"] == pytest.approx(np.sqrt(np.mean(e ** 2)))
    nz = np.abs(y) > 1e-12
    assert m["mape"] == pytest.approx(np.mean(np.abs(e[nz] / y[nz])) * 100)
    assert m["r2"] == pytest.approx(1 - np.sum(e ** 2) / np.sum((y - y.mean()) ** 2))
    one = forecast_metrics(pairs(spark, [1], [2]), "a", "p").first()
    assert one["r2"] is None
    const = forecast_metrics(pairs(spark, [2, 2], [2, 3]), "a", "p").first()
    assert const["r2"] == 0.0


def test_binary_metrics(spark):
    df = spark.createDataFrame([(bool(a), bool(b)) for a, b in zip([0, 1, 1, 0], [0, 1, 0, 0])], "l BOOLEAN, p BOOLEAN")
    m = anomaly_metrics(df, "l", "p").first()
    assert (m["precision"], m["recall"]) == (1.0, 0.5)
    assert [[m["tn"], m["fp"]], [m["fn"], m["tp"]]] == [[2, 0], [1, 1]]


@pytest.mark.parametrize("matrix,macro", [
    ([[366, 5], [23, 0]], 0.4816), ([[362, 9], [23, 0]], 0.4788), ([[140, 231], [6, 17]], 0.3335),
    ([[353, 18], [23, 0]], 0.4726), ([[346, 25], [23, 0]], 0.4676), ([[312, 59], [23, 0]], 0.4419),
])
def test_published_confusion_matrices(spark, matrix, macro):
    (tn, fp), (fn, tp) = matrix
    rows = [(False, False)] * tn + [(False, True)] * fp + [(True, False)] * fn + [(True, True)] * tp
    m = anomaly_metrics(spark.createDataFrame(rows, "l BOOLEAN, p BOOLEAN"), "l", "p").first()
    assert round(m["macro_f1"], 4) == macro


def test_all_negative_macro_f1_is_one(spark):
    df = spark.createDataFrame([(False, False)] * 3, "l BOOLEAN, p BOOLEAN")
    assert anomaly_metrics(df, "l", "p").first()["macro_f1"] == 1.0


def test_zero_scale_fit_flags_large_residual(spark):
    train = pairs(spark, [0, 0, 0, 0], [0, 0, 0, 0])
    test = pairs(spark, [1, 1, 10], [1, 1, 1]).coalesce(1)
    for det in (ResidualZScoreDetector(3.0), RobustResidualDetector(3.5)):
        det.fit(train, "a", "p")
        flags = [r["is_anomaly"] for r in det.score(test, "a", "p").collect()]
        assert flags == [False, False, True]


def test_all_zero_residuals_score_zero(spark):
    out = score_residuals(pairs(spark, [1, 1], [1, 1]), "a", "p").collect()
    assert [r["anomaly_score"] for r in out] == [0.0, 0.0] and not any(r["is_anomaly"] for r in out)
    out = score_robust_residuals(pairs(spark, [1, 1], [1, 1]), "a", "p").collect()
    assert [r["anomaly_score"] for r in out] == [0.0, 0.0]


def test_unfitted_detector_raises(spark):
    with pytest.raises(ValueError):
        ResidualZScoreDetector().score(pairs(spark, [1], [1]), "a", "p")


@pytest.mark.parametrize("method", ["refine", "sort"])
def test_exact_quantiles_match_numpy(spark, method):
    rng = np.random.default_rng(3)
    vals = np.round(rng.normal(0, 5, 501), 1)  # plenty of ties
    groups = rng.integers(0, 3, 501)
    df = spark.createDataFrame(pd.DataFrame({"g": groups.astype(int), "v": vals}))
    got = exact_quantiles(df, "v", [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0], by=["g"], method=method).toPandas().set_index("g")
    for g in range(3):
        exp = np.percentile(vals[groups == g], [0, 10, 25, 50, 75, 90, 100])
        assert np.allclose(got.loc[g].to_numpy(), exp, rtol=0, atol=1e-9)
    glob = exact_quantiles(df, "v", [0.5], method=method).first()[0]
    assert glob == pytest.approx(np.median(vals), abs=1e-9)
    med = exact_quantiles(spark.createDataFrame([(x,) for x in (1.0, 2.0, 4.0, 10.0)], "v DOUBLE"), "v", [0.5]).first()[0]
    assert med == 3.0


def test_robust_fallback_to_iqr(spark):
    # more than half zeros: MAD is 0, IQR of training residuals takes over
    res = [0.0] * 5 + [-4.0, 8.0, 9.0, 10.0]
    det = RobustResidualDetector(3.5).fit_residuals(spark.createDataFrame([(r,) for r in res], "r DOUBLE"), "r")
    q75, q25 = np.percentile(res, [75, 25])
    assert det.residual_median_ == 0.0
    assert det.residual_mad_ == pytest.approx((q75 - q25) / 1.349)
