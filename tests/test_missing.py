import numpy as np
import pandas as pd
import pytest
from conftest import hourly, make_panel
from pyspark.sql import functions as F

from wattlane.operators import detectors as det
from wattlane.operators.features import FeatureConfig, add_lag_features, add_rolling_features
from wattlane.operators.forest import fit_forest
from wattlane.operators.isoforest import fit_isolation_forest
from wattlane.operators.ridge import fit_ridge
from wattlane.plans.anomaly import grid_confusion

NAN = float("nan")


def residuals(spark, values, zone="z"):
    return spark.createDataFrame([(i, zone, v) for i, v in enumerate(values)], "i int, zone string, r double")


def test_a_missing_residual_is_never_flagged_and_teaches_nothing(spark):
    train = residuals(spark, [1.0, -1.0, NAN, None, 2.0, -2.0])
    test = residuals(spark, [NAN, None, 100.0, 0.0])
    known = np.array([1.0, -1.0, 2.0, -2.0])
    for d, z in ((det.ResidualZScoreDetector(3.0), 100 / known.std()),
                 (det.RobustResidualDetector(3.5), 0.6745 * 100 / np.median(np.abs(known)))):
        rows = d.fit_residuals(train, "r").score_residuals(test, "r").orderBy("i").collect()
        assert [r.is_anomaly for r in rows] == [False, False, True, False]
        assert rows[2].anomaly_score == pytest.approx(z)
    for self_fit in (det.score_residuals, det.score_robust_residuals):
        pairs = residuals(spark, [0.1, -0.2, 0.3, NAN]).withColumn("zero", F.lit(0.0))
        assert [r.is_anomaly for r in self_fit(pairs, "r", "zero").collect()] == [False] * 4
    with pytest.raises(ValueError, match="empty"):
        det.ResidualZScoreDetector().fit_residuals(residuals(spark, [NAN, None]), "r")


def test_constant_and_infinite_residuals_have_scale_one(spark):
    d = det.ResidualZScoreDetector(3.0).fit_residuals(residuals(spark, [0.0] * 5), "r")
    assert d.residual_std_ == 1.0
    assert d.score_residuals(residuals(spark, [9.0]), "r").first().is_anomaly
    assert det.ResidualZScoreDetector().fit_residuals(residuals(spark, [0.0, float("inf")]), "r").residual_std_ == 1.0


@pytest.mark.parametrize("cls", [det.ResidualZScoreDetector, det.RobustResidualDetector])
def test_zones_absent_from_the_fit_use_pooled_parameters(spark, cls):
    train = residuals(spark, [1.0, -1.0, 3.0, -3.0], "a").union(residuals(spark, [NAN, None], "b"))
    test = residuals(spark, [50.0], "a").union(residuals(spark, [50.0], "b")).union(residuals(spark, [50.0], "new"))
    rows = cls(3.0, by=("zone",)).fit_residuals(train, "r").score_residuals(test, "r").collect()
    assert len({r.anomaly_score for r in rows}) == 1 and all(r.is_anomaly for r in rows)


def test_threshold_grid_counts_each_row_once(spark):
    scores = [0.5, 1.5, 1.6, 2.0, 9.0, NAN, None, 3.0]
    df = spark.createDataFrame([(s, bool(i % 2)) for i, s in enumerate(scores)], "anomaly_score double, actual_anomaly boolean")
    for rule, grid in (("ge", [2.0, 1.5, 3.0, 2.0]), ("lt", [1.6, 0.1, 2.0])):
        for labels in (True, False):
            for c, g in zip(grid_confusion(df, grid, "anomaly_score", rule, labels), grid, strict=True):
                flags = [s is not None and s == s and (s >= g if rule == "ge" else s < g) for s in scores]
                assert c["detected_count"] == sum(flags)
                if labels:
                    assert c["tp"] == sum(f and i % 2 for i, f in enumerate(flags)) and c["labeled_anomaly_count"] == 4
                    assert c["tn"] + c["fp"] + c["fn"] + c["tp"] == len(scores)


def rolled(series, win, least=1):
    past = series.shift(1).rolling(win, min_periods=least)
    return past.mean(), past.std()


@pytest.mark.parametrize("strategy", ["zone", "blocked"])
def test_rolling_statistics_equal_pandas_over_gaps(spark, strategy):
    rng = np.random.default_rng(1)
    load = rng.normal(100, 10, 400)
    load[[0, 3, 50, 51, 52]] = NAN
    load[100:140] = NAN
    load[200] = np.inf
    pdf = pd.DataFrame({"timestamp": hourly(400), "zone": "z", "load_mw": load, "temperature_c": 1.0, "wind_speed_mps": 1.0,
                        "solar_radiation_wm2": 1.0})
    cfg = FeatureConfig(rolling_windows=(3, 24, 30, 500), rolling_min_periods=2, strategy=strategy, block_rows=1024)
    got = add_rolling_features(make_panel(spark, pdf), cfg).toPandas().sort_values("timestamp")
    assert list(got.columns)[6:] == [f"rolling_{s}_{w}" for w in (3, 24, 30, 500) for s in ("mean", "std")]
    for w in (3, 24, 30, 500):
        mean, std = rolled(pd.Series(load), w, 2)
        np.testing.assert_allclose(got[f"rolling_mean_{w}"].to_numpy(float), mean, rtol=1e-9, atol=1e-9)
        np.testing.assert_allclose(got[f"rolling_std_{w}"].to_numpy(float), std, rtol=1e-7, atol=1e-7)
    lags = add_lag_features(make_panel(spark, pdf), FeatureConfig(lag_periods=(1,))).toPandas().sort_values("timestamp")
    np.testing.assert_array_equal(lags["lag_1"].to_numpy(float), pd.Series(load).shift(1))


def test_quiet_stretch_after_a_noisy_one_keeps_its_digits(spark):
    rng = np.random.default_rng(2)
    load = np.concatenate([rng.normal(0, 1e9, 300), 1e6 + rng.normal(0, 1e-3, 300)])
    pdf = pd.DataFrame({"timestamp": hourly(600), "zone": "z", "load_mw": load, "temperature_c": 1.0, "wind_speed_mps": 1.0,
                        "solar_radiation_wm2": 1.0})
    got = add_rolling_features(make_panel(spark, pdf), FeatureConfig(rolling_windows=(48,))).toPandas().sort_values("timestamp")
    want = np.array([load[i - 48 : i].std(ddof=1) for i in range(400, 600)])  # windows of quiet rows alone
    np.testing.assert_allclose(got["rolling_std_48"].to_numpy(float)[400:], want, rtol=1e-6)
    np.testing.assert_allclose(got["rolling_mean_48"].to_numpy(float)[400:], [load[i - 48 : i].mean() for i in range(400, 600)], rtol=1e-12)


def test_rolling_windows_share_the_zones_exchange(spark):
    pdf = pd.DataFrame({"timestamp": hourly(9), "zone": "z", "load_mw": 1.0, "temperature_c": 1.0, "wind_speed_mps": 1.0,
                        "solar_radiation_wm2": 1.0})
    plan = add_rolling_features(make_panel(spark, pdf), FeatureConfig(strategy="zone"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_models_fill_nan_as_null(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (60, 2))
    y = 3 * x[:, 0] - x[:, 1] + 5
    rows = [(float(a), float(b), float(t)) for (a, b), t in zip(x, y, strict=True)]
    make = lambda gap: spark.createDataFrame(
        [(gap, 0.5, 4.0), (1.0, gap, 2.0), (1.0, 1.0, gap)] + rows, "a double, b double, target_load_mw double")
    null, nan = (fit_ridge(make(g), ["a", "b"], "target_load_mw") for g in (None, NAN))
    assert nan.coefficients == pytest.approx(null.coefficients) and np.isfinite(nan.coefficients).all()
    filled = make(NAN).toPandas().iloc[:-0 or None].dropna(subset=["target_load_mw"])
    filled = filled.fillna(make(NAN).toPandas().median())
    z = (filled[["a", "b"]] - filled[["a", "b"]].mean()) / filled[["a", "b"]].std(ddof=0)
    w = np.linalg.solve(z.T @ z + np.eye(2), z.T @ (filled["target_load_mw"] - filled["target_load_mw"].mean()))
    assert nan.coefficients == pytest.approx(list(w / filled[["a", "b"]].std(ddof=0)), rel=1e-6)
    odd = spark.createDataFrame([(NAN, 1.0)], "a double, b double")
    assert nan.predict(odd).first().prediction == pytest.approx(
        nan.intercept + nan.coefficients[0] * nan.medians["a"] + nan.coefficients[1])
    forest = fit_forest(make(NAN), ["a", "b"], "target_load_mw", num_trees=3, max_depth=4)
    same = spark.createDataFrame([(NAN, 1.0), (None, 1.0)], "a double, b double")
    a, b = (r.prediction for r in forest.predict(same).collect())
    assert a == b and np.isfinite(a)
    iso = [fit_isolation_forest(make(g).select("a", "b"), ["a", "b"], trees=5) for g in (NAN, None)]
    assert not iso[0].nodes["threshold"].isna().any() or iso[0].nodes["threshold"].notna().any()
    assert iso[0].score(same).where("anomaly_score IS NULL OR isnan(anomaly_score)").count() == 0


def test_store_keeps_models_and_versions_apart(spark, tmp_path):
    from wattlane.operators.ridge import fit_ridge_by
    from wattlane.sources import artifacts, store

    path = str(tmp_path / "store")
    rows = [(z, float(i % 7), float(i * i % 11), 3.0 * i + z) for z in (1, 2, 3) for i in range(30)]
    df = spark.createDataFrame(rows, "zone int, a double, b double, y double")
    with pytest.raises(KeyError):
        store.get(spark, path, "ridge")
    one, two = fit_ridge(df, ["a", "b"], "y"), fit_ridge(df.where("zone = 1"), ["a"], "y")
    assert (store.put(spark, path, "ridge", one), store.put(spark, path, "ridge", two), store.put(spark, path, "other", two)) == (1, 2, 1)
    assert store.get(spark, path, "ridge", 1) == one and store.get(spark, path, "ridge") == two == store.get(spark, path, "other")
    zones = fit_ridge_by(df, ["a", "b"], "y", ["zone"])
    det_z = det.ResidualZScoreDetector(2.0, by=("zone",)).fit(df, "y", "a")
    det_r = det.RobustResidualDetector(2.5).fit(df, "y", "a")
    iso = fit_isolation_forest(df, ["a", "b"], trees=3)
    for name, obj in (("zones", zones), ("z", det_z), ("r", det_r), ("iso", iso)):
        store.put(spark, path, name, obj)
        back = store.get(spark, path, name)
        assert type(back) is type(obj)
        if name == "zones":
            total = lambda m: m.predict(df).agg(F.sum("prediction")).first()[0]
            assert total(back) == pytest.approx(total(obj))
        else:
            score = lambda d: sorted(r.anomaly_score for r in (d.score(df) if name == "iso" else d.score(df, "y", "a")).collect())
            assert score(back) == score(obj)
    assert dict(store.get(spark, path, "z").params_.dtypes)["zone"] == "int"
    assert sorted((r.model_id, r.version) for r in store.versions(spark, path).collect()) == [
        ("iso", 1), ("other", 1), ("r", 1), ("ridge", 1), ("ridge", 2), ("z", 1), ("zones", 1)]
    with pytest.raises(KeyError):
        store.get(spark, path, "ridge", 9)
    with pytest.raises(ValueError, match="fitted"):
        store.put(spark, path, "x", det.ResidualZScoreDetector())
    with pytest.raises(ValueError, match="model_id"):
        store.put(spark, path, "a/b", one)
    loaded = artifacts.load_detector(spark, artifacts.save_detector(spark, det_z, str(tmp_path / "single")))
    assert dict(loaded.params_.dtypes)["zone"] == "int" and loaded.residual_mean_ == det_z.residual_mean_
