import json
import math
import random

import pytest

from wattlane.operators.detectors import ResidualZScoreDetector
from wattlane.operators.ridge import RidgeModel
from wattlane.plans.documents import answer_documents, answer_json, answered_records, judge_documents
from wattlane.streaming.documents import run_document_stream

MODEL = RidgeModel(["a", "b"], [2.0, -1.0], 0.5, {"a": 1.0, "b": 3.0})
DETECTOR = ResidualZScoreDetector(1.5, residual_mean_=0.0, residual_std_=2.0)


def lines(spark, docs):
    rows = [(i, d if isinstance(d, str) or d is None else json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "doc long, value string")


def rec(actual="none", **features):
    r = {"features": features}
    if actual != "none":
        r["actual_load_mw"] = actual
    return r


def reasons(spark, kind, docs, **kw):
    got = judge_documents(lines(spark, docs), kind, **kw).orderBy("doc").collect()
    return [(r.reason, r.reason_record) for r in got]


def test_reasons_of_batch_documents(spark):
    good = rec(a=1, b=2.5)
    cases = [
        ({"records": [good]}, None), ({"records": [good], "request_id": "x"}, None), ({"records": [good], "request_id": None}, None),
        (None, "malformed"), ("", "malformed"), ("[1]", "malformed"), ("{", "malformed"), ("{}", "malformed"), ("7", "malformed"),
        ({"records": good}, "malformed"), ({"records": "x"}, "malformed"), ({"records": []}, "no_records"),
        ({"request_id": 4}, "no_records"), ({"records": None}, "no_records"), ({"records": [good], "note": 1}, "unknown_field"),
        ({"records": [good] * 1000}, None), ({"records": [good] * 1001}, "too_many_records"),
        ({"records": [good, {**good, "x": 1}]}, ("unknown_field", 1)), ({"records": [good, {}]}, ("malformed", 1)),
        ({"records": [good, {"features": {}}]}, ("empty_features", 1)), ({"records": [{"features": None}]}, ("malformed", 0)),
        ({"records": [{"features": 5}, good]}, ("malformed", 0)), ({"records": [rec(**{" \t": 1, "a": 2})]}, ("blank_feature_name", 0)),
        ({"records": [rec(a=None)]}, ("non_finite_feature", 0)), ({"records": [rec(a="x")]}, ("non_finite_feature", 0)),
        ({"records": [rec(a=math.nan)]}, ("non_finite_feature", 0)), ({"records": [rec(a=math.inf)]}, ("non_finite_feature", 0)),
        ({"records": [rec(a={"b": 1})]}, ("non_finite_feature", 0)), ({"records": [rec(a="1d")]}, ("non_finite_feature", 0)),
        ({"records": [rec(a="1e3", b=" 2 ")]}, None), ({"records": [rec(a=1e400)]}, ("non_finite_feature", 0)),
        ({"records": [rec(5, a=1), rec(None, a=1)]}, "partial_actuals"), ({"records": [rec(5, a=1), rec(6, a=1)]}, None),
        ({"records": [rec("many", a=1)]}, ("non_finite_actual", 0)), ({"records": [rec(math.inf, a=1)]}, ("non_finite_actual", 0)),
        ({"records": [rec(None, a=1)]}, None),
        ('{"records": [{"features": {"a": 1, "a": 2}}], "records": [{"features": {"a": 3}}]}', None),  # the last of a repeated name counts
    ]
    want = [(r if isinstance(r, tuple) else (r, None)) for _, r in cases]
    assert reasons(spark, "batch", [d for d, _ in cases]) == want


def test_reasons_of_pairs_and_empty_tables(spark):
    pair = {"actual_load_mw": 1, "predicted_load_mw": 2}
    docs = [{"records": [pair]}, {"records": [{**pair, "features": {}}]}, {"records": [{"actual_load_mw": 1}]},
            {"records": [pair, {**pair, "predicted_load_mw": math.nan}]}]
    assert reasons(spark, "anomaly", docs) == [(None, None), ("unknown_field", 0), ("non_finite_load", 0), ("non_finite_load", 1)]
    assert judge_documents(lines(spark, docs).limit(0), "anomaly").count() == 0
    assert reasons(spark, "forecast", [{"records": [rec(5, a=1)]}]) == [("unknown_field", 0)]


def test_answers_without_ids_and_with_repeated_ones(spark):
    docs = [
        {"records": [rec(a=1, b=1), rec(a=2)]},  # b is known to the first record alone: its median for the second
        {"records": [rec(a=1, b=1)] * 600}, {"records": [rec(a=2, b=1)] * 600},  # neither has an id: not 1,200 records
        {"request_id": "r", "records": [rec(4.0, a=1, b=1)]}, {"request_id": "r", "records": [rec(a=1, b=1)]},
        {"records": [rec(a=1), rec(a=2)]},  # no record knows b
        {"records": [rec(a=1, b=1), rec(a="bad", b=2)]},  # one bad record
    ]
    answers = answer_documents(lines(spark, docs), "batch", MODEL, DETECTOR)
    got = {r.doc: r for r in answers.collect()}
    assert [got[i].status for i in range(7)] == [200, 200, 200, 200, 200, 422, 422]
    assert got[0].predictions == [1.5, 1.5] and got[0].anomalies is None and got[1].predictions == [1.5] * 600
    assert got[3].anomalies[0].anomaly_score == pytest.approx(1.25) and got[3].anomalies[0].is_anomaly is False
    assert got[5].detail == "Missing required features: b." and got[6].predictions is None
    assert answered_records(answers).count() == 2 + 600 + 600 + 1 + 1
    text = {r.doc: json.loads(r.answer) for r in answer_json(answers, MODEL).collect()}
    assert text[3]["predictions"] == [1.5] and text[3]["anomalies"] == [{"anomaly_score": 1.25, "is_anomaly": False}]
    assert text[0]["model_type"] == "ridge" and text[0]["forecast_horizon"] == 24 and text[5] == {"detail": got[5].detail}


def test_missing_models_are_unavailable(spark):
    docs = lines(spark, [{"records": [rec(1.0, a=1, b=1)]}, {"records": [rec(a=1, b=1)]}, "x"])
    assert [r.status for r in answer_documents(docs, "batch").orderBy("doc").collect()] == [503, 503, 422]
    got = answer_documents(docs, "batch", MODEL).orderBy("doc").collect()
    assert [(r.status, r.detail) for r in got[:2]] == [(503, "Anomaly detector is unavailable."), (200, None)]
    pairs = lines(spark, [{"records": [{"actual_load_mw": 1, "predicted_load_mw": 2}]}])
    assert answer_documents(pairs, "anomaly").first().detail == "Anomaly detector is unavailable."
    assert json.loads(answer_json(answer_documents(pairs, "anomaly", detector=DETECTOR)).first().answer) == {
        "results": [{"anomaly_score": 0.5, "is_anomaly": False}]}


def test_documents_are_answered_without_a_shuffle(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(json.dumps({"records": [rec(1.0, a=1, b=1)]}) + "\n")
    answers = answered_records(answer_documents(spark.read.text(str(tmp_path / "in")), "batch", MODEL, DETECTOR))
    plan = answers._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and answers.count() == 1


def test_stream_neither_loses_nor_repeats_documents_when_a_batch_fails(spark, tmp_path, monkeypatch):
    from wattlane.streaming import documents

    rng = random.Random(3)
    source = tmp_path / "in"
    source.mkdir()
    docs = [{"records": [rec(a=i, b=rng.random())] * rng.randint(1, 3)} if i % 4 else {"records": []} for i in range(40)]
    for k in range(4):
        (source / f"{k}.json").write_text("\n".join(json.dumps(d) for d in docs[k * 10 : k * 10 + 10]))
    real, calls = documents.answered_records, []

    def failing(answers):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost")
        return real(answers)

    monkeypatch.setattr(documents, "answered_records", failing)
    run = lambda: run_document_stream(spark, str(source), str(tmp_path / "ok"), str(tmp_path / "bad"), str(tmp_path / "cp"),
                                      "forecast", MODEL, max_files_per_trigger=1)
    with pytest.raises(Exception, match="lost"):
        run().awaitTermination()
    run().awaitTermination()
    good = spark.read.parquet(str(tmp_path / "ok"))
    bad = spark.read.parquet(str(tmp_path / "bad"))
    assert good.count() == sum(len(d["records"]) for d in docs) and bad.count() == 10
    assert sorted({r.a for r in good.selectExpr("get_json_object(value, '$.records[0].features.a') AS a").collect()}, key=int) == [
        str(i) for i in range(40) if i % 4]


@pytest.mark.parametrize("kind", ["batch", "forecast", "anomaly"])
def test_documents_are_parsed_once_for_their_answers(spark, kind):
    answers = answer_documents(lines(spark, []), kind, MODEL, DETECTOR)
    plan = answered_records(answers)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if " Filter " in f" {line}" and "from_json" in line]
    assert plan.count("from_json") <= 3  # the document, its records, their features
