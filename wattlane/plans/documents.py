"""Q1-Q4, C13 by document: JSON requests judged and answered as a whole.

A request document stays one row. Its records are an array, and every rule
(size, types, names, finite values, all or no actuals, features that no record
has) is a higher-order function over it, so neither a join, a grouping nor an
id is needed, and the same plan serves tables and streams. One bad record
rejects its document. Documents are bounded by ``max_records``; the records of a
longer one are never parsed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.functions.jsonsafe import all_names_nonblank
from wattlane.operators.detectors import ResidualZScoreDetector, RobustResidualDetector, flagged
from wattlane.operators.ridge import RidgeModel
from wattlane.operators.validate import NUMERIC_PATTERN
from wattlane.plans.requests import MAX_RECORDS, RECORD_FIELDS, REQUEST_FIELDS

Detector = ResidualZScoreDetector | RobustResidualDetector

#: what a rejected document is told
DETAILS = {
    "malformed": "The document is not a JSON object with a list of records.",
    "unknown_field": "Unknown fields are not allowed.",
    "no_records": "At least one record is required.",
    "too_many_records": "Too many records.",
    "empty_features": "Features must not be empty.",
    "blank_feature_name": "Feature names must be non-empty.",
    "non_finite_feature": "Feature values must be finite.",
    "non_finite_actual": "actual_load_mw must be finite.",
    "non_finite_load": "Load values must be finite.",
    "partial_actuals": "actual_load_mw must be provided for all records or no records.",
}
NO_MODEL = "Forecast model is unavailable."
NO_DETECTOR = "Anomaly detector is unavailable."


def _number(text: Column) -> Column:
    """A finite number of a JSON value's text; quoted numbers count, other texts, booleans and null don't."""

    x = F.when(text.rlike(NUMERIC_PATTERN), F.trim(text).try_cast("double"))
    return F.when(F.abs(x) != float("inf"), x)


def _unknown(keys: Column, names: Sequence[str]) -> Column:
    return F.exists(keys, lambda k: ~k.isin(*names))


def _records(rows: Column, kind: str) -> Column:
    """The records, in steps: what a step has parsed is a field for the next, else every use of it would parse it again."""

    if "features" not in RECORD_FIELDS[kind]:
        return F.transform(rows, lambda r: _record(r, kind))
    parsed = F.transform(rows, lambda r: F.struct(
        r.alias("row"), F.from_json(F.try_element_at(r, F.lit("features")), "map<string,string>").alias("texts")))
    parsed = F.transform(parsed, lambda p: F.struct(
        p["row"].alias("row"), p["texts"].alias("texts"), F.transform_values(p["texts"], lambda _, v: _number(v)).alias("numbers")))
    return F.transform(parsed, lambda p: _record(p["row"], kind, p["texts"], p["numbers"]))


def _record(r: Column, kind: str, texts: Column | None = None, numbers: Column | None = None) -> Column:
    """A record's fields as numbers, and its first problem; ``texts`` and ``numbers`` are its features."""

    given = {n: F.try_element_at(r, F.lit(n)) for n in RECORD_FIELDS[kind]}
    out, rules = [], [(r.isNull(), "malformed"), (_unknown(F.map_keys(r), RECORD_FIELDS[kind]), "unknown_field")]
    if "features" in given:
        rules += [(texts.isNull(), "malformed"), (F.size(texts) == 0, "empty_features"),
                  (~all_names_nonblank(texts), "blank_feature_name"),
                  (F.exists(F.map_values(numbers), lambda v: v.isNull()), "non_finite_feature")]
        out.append(numbers.alias("features"))
    for n in ("actual_load_mw", "predicted_load_mw"):
        if n in given:
            needed = F.lit(True) if kind == "anomaly" else given[n].isNotNull()
            rules.append((needed & _number(given[n]).isNull(), "non_finite_load" if kind == "anomaly" else "non_finite_actual"))
            out.append(_number(given[n]).alias(n))
    problem = F.lit(None).cast("string")
    for bad, name in reversed(rules):
        problem = F.when(bad, F.lit(name)).otherwise(problem)
    return F.struct(*out, problem.alias("problem"))


def judge_documents(lines: DataFrame, kind: str, column: str = "value", max_records: int = MAX_RECORDS) -> DataFrame:
    """Q4: ``lines`` with request_id, n_records, records, ``reason`` and ``reason_record``, one row per document.

    ``kind`` is forecast, anomaly or batch. A document is ``{"records": [...]}``, and
    may have a request_id (text here), which need be neither there nor unique.
    ``reason`` is NULL for a valid document, else what is wrong with it or with
    its first bad record, whose 0-based place is ``reason_record``.
    """

    texts = "map<string,string>"
    doc = lines.withColumn("_doc", F.from_json(F.col(column), texts))
    doc = doc.withColumn("_list", F.from_json(F.try_element_at("_doc", F.lit("records")), f"array<{texts}>"))
    size = F.coalesce(F.size("_list"), F.lit(-1))
    doc = doc.withColumn("records", F.when(size.between(1, max_records), _records(F.col("_list"), kind)))
    problems = F.transform("records", lambda r, i: F.struct(r["problem"].alias("reason"), i.cast("long").alias("record")))
    doc = doc.withColumn("_bad", F.get(F.filter(problems, lambda p: p["reason"].isNotNull()), F.lit(0)))
    reason = (
        F.when(F.col("_doc").isNull() | (F.size("_doc") == 0), F.lit("malformed"))
        .when(_unknown(F.map_keys("_doc"), REQUEST_FIELDS), F.lit("unknown_field"))
        .when(F.try_element_at("_doc", F.lit("records")).isNotNull() & (size < 0), F.lit("malformed"))
        .when(size <= 0, F.lit("no_records"))
        .when(size > max_records, F.lit("too_many_records"))
        .when(F.col("_bad").isNotNull(), F.col("_bad.reason"))
    )
    if kind == "batch":
        some = F.exists("records", lambda r: r["actual_load_mw"].isNotNull())
        every = F.forall("records", lambda r: r["actual_load_mw"].isNotNull())
        reason = reason.when(some & ~every, F.lit("partial_actuals"))
    return doc.select(
        *lines.columns, F.try_element_at("_doc", F.lit("request_id")).alias("request_id"),
        F.greatest(size, F.lit(0)).cast("long").alias("n_records"),
        F.transform("records", lambda r: r.dropFields("problem")).alias("records"),
        reason.alias("reason"), F.col("_bad.record").alias("reason_record"),
    )


def _scores(detector: Detector, actual: Column, predicted: Column) -> Column:
    score = detector.pooled_score(actual - predicted)
    return F.struct(score.alias("anomaly_score"), flagged(score, detector.threshold).alias("is_anomaly"))


def answer_documents(lines: DataFrame, kind: str, model: RidgeModel | None = None, detector: Detector | None = None, *,
                     column: str = "value", max_records: int = MAX_RECORDS) -> DataFrame:
    """Q1-Q3: ``lines`` with request_id, status, detail, predictions, anomalies, one row per document.

    Status 200 is an answer: ``predictions`` in the order of the records (forecast
    and batch), ``anomalies`` as (anomaly_score, is_anomaly) where actuals are
    given. 422 is a rejected document: by ``judge_documents``, or because no record
    has a feature of the model; a feature that only some records lack is filled
    with the model's median. 503 says that what the document needs is not there.
    """

    docs = judge_documents(lines, kind, column, max_records)
    detail = F.col("reason")
    for reason, text in DETAILS.items():
        detail = F.when(F.col("reason") == reason, F.lit(text)).otherwise(detail)
    detail = F.when(F.col("reason").isNotNull(), detail)
    lacks_model, lacks_detector = F.lit(False), F.lit(False)
    predictions, anomalies = F.lit(None).cast("array<double>"), F.lit(None).cast("array<struct<anomaly_score:double,is_anomaly:boolean>>")
    if kind == "anomaly":
        lacks_detector = F.lit(detector is None)
        if detector is not None:
            anomalies = F.transform("records", lambda r: _scores(detector, r["actual_load_mw"], r["predicted_load_mw"]))
    else:
        lacks_model = F.lit(model is None)
        if model is not None:
            names = F.array(*[F.lit(n) for n in model.feature_names])
            absent = F.filter(names, lambda n: ~F.exists("records", lambda r: F.map_contains_key(r["features"], n)))
            detail = F.coalesce(detail, F.when(F.size(absent) > 0, F.concat(
                F.lit("Missing required features: "), F.array_join(absent, ", "), F.lit("."))))
            predictions = F.transform("records", lambda r: model.prediction_column(
                lambda n: F.try_element_at(r["features"], F.lit(n))))
        if kind == "batch":
            actuals = F.coalesce(F.get("records", F.lit(0))["actual_load_mw"].isNotNull(), F.lit(False))
            lacks_detector = actuals & F.lit(detector is None)
            if detector is not None:
                anomalies = F.when(actuals, F.zip_with("predictions", "records", lambda p, r: _scores(detector, r["actual_load_mw"], p)))
    docs = docs.withColumn("detail", detail)
    docs = docs.withColumn("status", F.when(F.col("reason").isNotNull(), 422).when(lacks_model, 503).when(
        F.col("detail").isNotNull(), 422).when(lacks_detector, 503).otherwise(200))
    missing = F.when(lacks_model, F.lit(NO_MODEL)).otherwise(F.lit(NO_DETECTOR))
    docs = docs.withColumn("detail", F.when(F.col("status") == 503, missing).otherwise(F.col("detail")))
    docs = docs.withColumn("predictions", F.when(F.col("status") == 200, predictions))
    docs = docs.withColumn("anomalies", F.when(F.col("status") == 200, anomalies))
    return docs.select(*lines.columns, "request_id", "status", "detail", "predictions", "anomalies")


def answer_json(answers: DataFrame, model: RidgeModel | None = None, name: str = "answer") -> DataFrame:
    """``answers`` with the JSON text that goes back: predictions, results or anomalies, or the detail of an error."""

    results = F.col("anomalies")
    if model is None:
        good = F.to_json(F.struct(results.alias("results")))
    else:
        good = F.to_json(F.struct(F.lit(model.forecast_horizon).alias("forecast_horizon"), F.lit(model.model_type).alias("model_type"),
                                  F.col("predictions"), results.alias("anomalies")))
    return answers.withColumn(name, F.when(F.col("status") == 200, good).otherwise(F.to_json(F.struct("detail"))))


def answered_records(answers: DataFrame) -> DataFrame:
    """One row per record of the answered documents: the documents' columns, record_idx, prediction, anomaly_score, is_anomaly.

    Documents without an answer have neither array, so they have no rows. A filter on their status is left out: Spark
    would push it below the parsing, and parse and judge every document once more for it.
    """

    kept = [c for c in answers.columns if c not in ("status", "detail", "predictions", "anomalies")]
    size = F.coalesce(F.array_size("predictions"), F.array_size("anomalies"))
    rows = answers.select("*", F.explode(F.sequence(F.lit(0), size - 1)).alias("_i"))
    scored = F.get("anomalies", F.col("_i"))
    return rows.select(*kept, F.col("_i").cast("long").alias("record_idx"), F.get("predictions", F.col("_i")).alias("prediction"),
                       scored["anomaly_score"].alias("anomaly_score"), scored["is_anomaly"].alias("is_anomaly"))
