import numpy as np
import pandas as pd
import pytest

from wattlane.operators.isoforest import fit_isolation_forest
from wattlane.operators.ridge import RidgeModel, fit_ridge


def closed_form(x, y, alpha=1.0):
    mu, sd = x.mean(0), x.std(0)
    sd = np.where(sd == 0, 1.0, sd)
    z = (x - mu) / sd
    w = np.linalg.solve(z.T @ z + alpha * np.eye(x.shape[1]), z.T @ (y - y.mean()))
    coef = w / sd
    return coef, y.mean() - coef @ mu


def tiny(spark):
    pdf = pd.DataFrame({"load_mw": [10.0, 11, 12, 13, 14, 15], "temperature_c": [1, 1.2, 1.1, 1.4, 1.5, 1.6],
                        "hour": [0, 1, 2, 3, 4, 5], "target_load_mw": [11.0, 12, 13, 14, 15, 16]})
    return pdf, spark.createDataFrame(pdf)


def test_ridge_matches_closed_form_and_persists(spark, tmp_path):
    pdf, df = tiny(spark)
    feats = ["load_mw", "temperature_c", "hour"]
    model = fit_ridge(df, feats, "target_load_mw")
    coef, b = closed_form(pdf[feats].to_numpy(), pdf["target_load_mw"].to_numpy())
    assert np.allclose(model.coefficients, coef, atol=1e-10) and model.intercept == pytest.approx(b)
    new = spark.createDataFrame([(16.0, 1.7, 6), (17.0, 1.8, 7)], "load_mw DOUBLE, temperature_c DOUBLE, hour INT")
    p1 = [r["prediction"] for r in model.predict(new).collect()]
    path = str(tmp_path / "ridge")
    model.save(spark, path)
    p2 = [r["prediction"] for r in RidgeModel.load(spark, path).predict(new).collect()]
    assert len(p1) == 2 and np.allclose(p1, p2)
    with pytest.raises(ValueError):
        model.predict(new.drop("hour"))


def test_constant_feature_gets_zero_coefficient(spark):
    df = spark.createDataFrame([(float(i), 5.0, 2.0 * i + 1) for i in range(10)], "x DOUBLE, c DOUBLE, y DOUBLE")
    m = fit_ridge(df, ["x", "c"], "y", impute=False)
    assert m.coefficients[1] == 0.0


def test_median_imputation_at_predict(spark):
    pdf, df = tiny(spark)
    m = fit_ridge(df, ["load_mw", "temperature_c"], "target_load_mw")
    assert m.medians["load_mw"] == 12.5
    row = spark.createDataFrame([(None, 1.3)], "load_mw DOUBLE, temperature_c DOUBLE")
    full = spark.createDataFrame([(12.5, 1.3)], "load_mw DOUBLE, temperature_c DOUBLE")
    assert m.predict(row).first()["prediction"] == pytest.approx(m.predict(full).first()["prediction"])


def test_isolation_forest_shape_and_outlier(spark):
    df = spark.createDataFrame([(10.0, 5.0), (10.2, 5.1), (9.9, 5.0), (10.1, 5.2), (30.0, 5.0)],
                               "load_mw DOUBLE, temperature_c DOUBLE")
    forest = fit_isolation_forest(df, ["load_mw", "temperature_c"], contamination=0.2)
    out = forest.score(df).toPandas()
    assert len(out) == 5 and {"anomaly_score", "is_anomaly"} <= set(out.columns)
    assert out["anomaly_score"].idxmax() == 4


def test_isolation_forest_deterministic(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame(rng.normal(size=(400, 3)), columns=["a", "b", "c"])
    df = spark.createDataFrame(pdf)
    s1 = fit_isolation_forest(df, ["a", "b", "c"]).score(df).toPandas().sort_values("a")
    s2 = fit_isolation_forest(df.repartition(5), ["a", "b", "c"]).score(df).toPandas().sort_values("a")
    assert np.allclose(s1["anomaly_score"], s2["anomaly_score"])


def test_per_zone_ridge_equals_separate_fits(spark):
    from pyspark.sql import functions as F

    from wattlane.operators.ridge import fit_ridge_by

    rng = np.random.default_rng(5)
    rows = []
    for z, (a, b) in {"n": (2.0, 1.0), "s": (-1.0, 3.0), "e": (0.5, -2.0)}.items():
        for _ in range(60):
            x1, x2 = rng.normal(size=2)
            rows.append((z, float(x1), float(x2), float(a * x1 + b * x2 + rng.normal(0, 0.1))))
    df = spark.createDataFrame(rows, "zone STRING, x1 DOUBLE, x2 DOUBLE, y DOUBLE")
    model = fit_ridge_by(df, ["x1", "x2"], "y", ["zone"])
    got = model.predict(df).toPandas()
    for z in ("n", "s", "e"):
        part = df.where(F.col("zone") == z)
        single = fit_ridge(part, ["x1", "x2"], "y", impute=False)
        exp = single.predict(part).toPandas()["prediction"].to_numpy()
        assert np.allclose(np.sort(got[got["zone"] == z]["prediction"].to_numpy()), np.sort(exp), atol=1e-8)


def _wavy(spark, n=600):
    rng = np.random.default_rng(3)
    a, b, c = rng.normal(size=n), rng.integers(0, 9, n).astype(float), rng.uniform(size=n)
    pdf = pd.DataFrame({"id": range(n), "a": a, "b": b, "c": c, "y": 5 * np.sin(a) + b + rng.normal(0, 0.1, n)})
    return spark.createDataFrame(pdf), pdf


def test_forest_depends_on_neither_partitions_nor_where_branches_begin(spark, monkeypatch):
    from wattlane.operators import forest

    df, pdf = _wavy(spark)

    def predicted(rows):
        model = forest.fit_forest(rows, ["a", "b", "c"], "y", num_trees=4)
        out = model.predict(rows.unionByName(rows)).toPandas().sort_values("id", kind="stable")
        assert len(out) == 1200 and list(out.columns) == ["id", "a", "b", "c", "y", "prediction"]
        return model, out["prediction"].to_numpy()[::2]

    _, whole = predicted(df)
    assert np.mean((whole - pdf["y"]) ** 2) < 0.1 * pdf["y"].var()
    assert np.allclose(whole, predicted(df.repartition(7, "c"))[1])
    monkeypatch.setattr(forest, "LOCAL_ROWS", 40)  # upper levels by histograms, full branches predicted in parts
    monkeypatch.setattr(forest, "HISTOGRAM_BYTES", 3 * 3 * 32 * 8 * 3)  # three nodes a pass
    model, cut = predicted(df)
    assert model.trees.where("root >= 0").count() > 4 * 8
    assert np.allclose(whole, cut)


def test_branch_equals_an_exact_tree(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import DecisionTreeRegressor

    from wattlane.operators.forest import _grow, _route

    rng = np.random.default_rng(8)
    codes = rng.integers(0, 12, (300, 3)).astype(np.uint8)
    y, w = rng.normal(size=300) + codes[:, 1] ** 2 % 7, rng.integers(1, 4, 300).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"a": codes[:, 0], "b": codes[:, 1], "c": codes[:, 2], "y": y, "w": w}).astype(float))
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="x").transform(df)
    for depth in (1, 4, 8):
        tree = DecisionTreeRegressor(featuresCol="x", labelCol="y", weightCol="w", maxDepth=depth).fit(df)
        exp = np.array([r["prediction"] for r in tree.transform(df).collect()])
        nodes = _grow(codes, y, w, depth)
        assert np.allclose(nodes["value"][_route(nodes, codes)], exp)


def test_forest_of_few_or_equal_rows(spark):
    from wattlane.operators.forest import fit_forest

    one = spark.createDataFrame([(1.0, 7.0)], "a DOUBLE, y DOUBLE")
    assert [r["prediction"] for r in fit_forest(one, ["a"], "y", num_trees=6).predict(one).collect()] == [7.0]
    same = spark.createDataFrame([(1.0, 7.0), (1.0, 9.0)] * 500 + [(None, 8.0)], "a DOUBLE, y DOUBLE")
    got = {r["prediction"] for r in fit_forest(same, ["a"], "y", num_trees=6).predict(same).collect()}
    assert len(got) == 1 and abs(got.pop() - 8.0) < 0.2
    with pytest.raises(ValueError, match="No rows"):
        fit_forest(one.where("a > 1"), ["a"], "y")


def test_draws_are_poisson():
    from wattlane.operators.forest import _Draws

    digest = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 200_000)
    for rate in (1, 3, 400):
        w = _Draws(42).weights(digest, np.full(len(digest), rate), 5)
        assert abs(w.mean() - rate) < 0.02 * rate and abs(w.var() - rate) < 0.03 * rate
    assert not np.array_equal(_Draws(42).weights(digest, np.ones(len(digest), int), 6), _Draws(42).weights(digest, np.ones(len(digest), int), 7))


def test_store_keeps_forests(spark, tmp_path):
    from wattlane.operators.forest import fit_forest
    from wattlane.sources import store

    df, _ = _wavy(spark, 60)
    model = fit_forest(df, ["a", "b"], "y", num_trees=3)
    assert store.put(spark, str(tmp_path / "s"), "f", model) == 1
    again = store.get(spark, str(tmp_path / "s"), "f")
    assert again.predict(df).orderBy("id").collect() == model.predict(df).orderBy("id").collect()


def test_forest_forecast_computes_windows_once(spark, tmp_path, monkeypatch):
    from wattlane import catalog

    spark.range(400).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, id) AS ts", "id % 7 AS user_id",
        "'view' AS event_type", "CAST(id % 13 AS DOUBLE) AS value", "concat('{\"k\": ', id % 5, '}') AS props",
    ).write.parquet(str(tmp_path / "events.parquet"))
    seen, build = [], catalog.build_supervised_frame
    monkeypatch.setattr(catalog, "build_supervised_frame", lambda df: seen.append(df) or build(df))
    rows = catalog.forest_forecast(spark, str(tmp_path)).collect()
    assert len(rows) == round((400 - 168 - 24) * 0.2)
    assert "Window" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("few", [0, 1, 9])
def test_few_rows_compared_split_as_histograms_do(monkeypatch, few):
    from wattlane.operators import forest

    rng = np.random.default_rng(few)
    codes = rng.integers(0, 9, (2500, 4)).astype(np.uint8)
    codes[:, 3] = 0
    y, w = rng.integers(0, 40, 2500) / 4 + codes[:, 1], rng.integers(1, 4, 2500).astype(float)
    exp = forest._grow(codes, y, w, 30)
    monkeypatch.setattr(forest, "FEW", few)
    monkeypatch.setattr(forest, "NODES", 3)
    got = forest._grow(codes, y, w, 30)
    for name in ("feature", "bin", "left"):
        assert np.array_equal(got[name], exp[name])
    assert np.allclose(got["value"], exp["value"])


def test_trees_are_stored_in_few_bytes(spark):
    from wattlane.operators import forest

    rng = np.random.default_rng(1)
    codes = rng.integers(0, 20, (500, 3)).astype(np.uint8)
    nodes = forest._grow(codes, rng.normal(size=500), np.ones(500), 30)
    inner = nodes["feature"] >= 0
    again = forest._restored(forest._stored(nodes))
    assert all(np.array_equal(again[c], nodes[c]) for c in ("feature", "left"))
    assert np.array_equal(again["bin"][inner], nodes["bin"][inner]) and np.array_equal(again["value"][~inner], nodes["value"][~inner])
    model = forest.fit_forest(_wavy(spark)[0], ["a", "b", "c"], "y", num_trees=3)
    stored = [r["nodes"] for r in model.trees.where("root >= 0").collect()]
    assert sum(map(len, stored)) < 8 * sum(len(forest._restored(x)) for x in stored)
