"""Request tables scored as Spark jobs (re-aim of the HTTP layer).

A request table has one row per record:
``request_id BIGINT, record_idx BIGINT, features MAP<STRING,DOUBLE>, actual_load_mw DOUBLE``.
Documents as they arrive, whose records must not be mixed up, are judged and
answered in ``plans.documents``.
Per-request rules (size limits, "actual for all or none", features missing
from every record) come from one ``groupBy(request_id)`` aggregate joined
back on the request id -- no window, so a huge request is aggregated with
map-side partial sums instead of landing in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.functions.jsonsafe import (
    all_names_nonblank, all_values_finite, features_to_map, finite_or_null, map_to_features, to_json_safe,
)
from wattlane.operators.detectors import ResidualZScoreDetector, RobustResidualDetector
from wattlane.operators.ordering import tail_rows
from wattlane.operators.ridge import RidgeModel
from wattlane.schema import TARGET

REQUEST_SCHEMA = "request_id BIGINT, record_idx BIGINT, features MAP<STRING,DOUBLE>, actual_load_mw DOUBLE"
MAX_RECORDS = 1000


#: fields that a record of each kind of request may have; a request itself has these two
RECORD_FIELDS = {
    "forecast": ("features",),
    "anomaly": ("actual_load_mw", "predicted_load_mw"),
    "batch": ("features", "actual_load_mw"),
}
REQUEST_FIELDS = ("request_id", "records")


def parse_requests(lines: DataFrame, kind: str, column: str = "value") -> DataFrame:
    """Q1, Q4: JSON documents ``{"request_id", "records": [...]}``, one a row, to one row per record.

    Returns request_id, record_idx, the fields of the kind's records and
    ``problem``: ``malformed`` (no JSON object, a record that is no object, or a
    field of another type), ``unknown_field`` (of the document or a record), or
    ``no_records``; NULL for the others. A document without records gives one row.
    """

    allowed = RECORD_FIELDS[kind]
    texts = "map<string,string>"
    doc = lines.select(F.from_json(F.col(column), texts, {"mode": "PERMISSIVE"}).alias("doc"))
    doc = doc.select("doc", F.from_json(F.try_element_at("doc", F.lit("records")), f"array<{texts}>").alias("records"))
    rows = doc.select("doc", "records", F.posexplode_outer("records").alias("record_idx", "record"))

    def unknown(m: str, names: Sequence[str]) -> Column:
        return F.exists(F.map_keys(m), lambda k: ~k.isin(*names))

    def number(name: str) -> Column:
        return F.try_element_at("record", F.lit(name)).try_cast("double")

    def unread(name: str) -> Column:
        return F.try_element_at("record", F.lit(name)).isNotNull() & number(name).isNull()

    values = {"features": F.from_json(F.try_element_at("record", F.lit("features")), "map<string,double>")}
    values |= {n: number(n) for n in allowed if n != "features"}
    bad = F.lit(False)
    for n in allowed:
        bad = bad | (unread(n) if n != "features" else F.try_element_at("record", F.lit(n)).isNull() | values[n].isNull())
    problem = (
        F.when(F.col("doc").isNull() | (F.size("doc") == 0), F.lit("malformed"))
        .when(unknown("doc", REQUEST_FIELDS), F.lit("unknown_field"))
        .when(F.col("records").isNull() | (F.size("records") == 0), F.lit("no_records"))
        .when(F.col("record").isNull(), F.lit("malformed"))
        .when(unknown("record", allowed), F.lit("unknown_field"))
        .when(bad, F.lit("malformed"))
    )
    return rows.select(
        F.try_element_at("doc", F.lit("request_id")).try_cast("long").alias("request_id"),
        F.coalesce(F.col("record_idx"), F.lit(0)).cast("long").alias("record_idx"),
        *[values[n].alias(n) for n in allowed], problem.alias("problem"),
    )


def validate_pairs(pairs: DataFrame, max_records: int = MAX_RECORDS) -> DataFrame:
    """Q2, Q4: per (actual, predicted) record ``valid`` and the first failing ``reason``."""

    sizes = pairs.groupBy("request_id").agg(F.count(F.lit(1)).alias("_records"))
    reason = F.when(F.col("_records") > max_records, F.lit("too_many_records"))
    if "problem" in pairs.columns:
        reason = reason.when(F.col("problem").isNotNull(), F.col("problem"))
    for c in ("actual_load_mw", "predicted_load_mw"):
        reason = reason.when(~_finite(F.col(c)), F.lit("non_finite_load"))
    joined = pairs.join(sizes.withColumnRenamed("request_id", "_id"), F.col("request_id").eqNullSafe(F.col("_id")))
    return joined.select("request_id", "record_idx", "actual_load_mw", "predicted_load_mw",
                         reason.isNull().alias("valid"), reason.alias("reason"))


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def validate_requests(req: DataFrame, max_records: int = MAX_RECORDS) -> DataFrame:
    """Q4: per record ``valid`` and the first failing ``reason``; a ``problem`` of the parse comes first."""

    sizes = req.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("_records"),
        F.count(F.col("actual_load_mw")).alias("_actuals"),
    )
    j = req.join(sizes.withColumnRenamed("request_id", "_id"), F.col("request_id").eqNullSafe(F.col("_id")))
    feats = F.col("features")
    problem = F.col("problem") if "problem" in req.columns else F.lit(None).cast("string")
    reason = (
        F.when(F.col("_records") > max_records, F.lit("too_many_records"))
        .when(problem.isNotNull(), problem)
        .when(feats.isNull() | (F.size(feats) == 0), F.lit("empty_features"))
        .when(~all_names_nonblank(feats), F.lit("blank_feature_name"))
        .when(~all_values_finite(feats), F.lit("non_finite_feature"))
        .when(F.col("actual_load_mw").isNotNull() & ~_finite(F.col("actual_load_mw")), F.lit("non_finite_actual"))
        .when((F.col("_actuals") > 0) & (F.col("_actuals") < F.col("_records")), F.lit("partial_actuals"))
    )
    return j.select(
        "request_id", "record_idx", "features", "actual_load_mw",
        reason.isNull().alias("valid"), reason.alias("reason"),
    )


def forecast_requests(req: DataFrame, model: RidgeModel) -> DataFrame:
    """Q1: predictions per record; a feature absent from every record of a request is an error."""

    return _predicted(req, model).select("request_id", "record_idx", "prediction", "error")


def _predicted(req: DataFrame, model: RidgeModel) -> DataFrame:
    """Predictions and errors, with the request's numbers of records and actuals (``_n``, ``_a``).

    One aggregate by request and one join, which carries every record's own
    columns, so repeated record numbers stay as many rows. Features absent from only some records are imputed with the model's
    training medians (inside the model's prediction expression).
    """

    names = list(model.feature_names)
    present = req.groupBy("request_id").agg(
        F.count(F.lit(1)).alias("_n"), F.count("actual_load_mw").alias("_a"),
        *[F.count_if(F.map_contains_key("features", n)).alias(f"_p{i}") for i, n in enumerate(names)],
    )
    missing = F.concat_ws(
        ", ", *[F.when(F.col(f"_p{i}") == 0, F.lit(n)) for i, n in enumerate(names)]
    )
    covered = present.select("request_id", "_n", "_a", missing.alias("_missing"))
    covered = covered.withColumnRenamed("request_id", "_id")
    # records without a request_id are one request of this table; documents without ids: see ``plans.documents``
    rows = req.join(covered, F.col("request_id").eqNullSafe(F.col("_id"))).drop("_id").select(F.struct("*").alias("_req"), *map_to_features("features", names))
    expanded = rows.select("*", F.col("_req._missing").alias("_missing"))
    pred = model.prediction_column()
    return expanded.select(
        "_req.request_id", "_req.record_idx", "_req.actual_load_mw",
        F.when(F.col("_missing") == "", pred).alias("prediction"),
        F.when(F.col("_missing") != "", F.concat(F.lit("Missing required features: "), F.col("_missing"), F.lit(".")))
        .alias("error"),
        F.col("_req._n").alias("_n"), F.col("_req._a").alias("_a"),
    )


def score_pairs(
    pairs: DataFrame,
    detector: ResidualZScoreDetector | RobustResidualDetector,
    actual: str = "actual_load_mw",
    predicted: str = "predicted_load_mw",
) -> DataFrame:
    """Q2: score (actual, predicted) pairs with a fitted detector (map-only)."""

    return detector.score(pairs, actual, predicted)


def batch_predict(req: DataFrame, model: RidgeModel, detector: ResidualZScoreDetector | None = None) -> DataFrame:
    """Q3: predictions plus anomaly scores when every record of a request has an actual."""

    j = _predicted(req, model)
    mixed = (F.col("_a") > 0) & (F.col("_a") < F.col("_n"))
    problems = [F.when(mixed, F.lit("actual_load_mw must be provided for all records or no records."))]
    if detector is None:
        problems.append(F.when(F.col("_a") > 0, F.lit("Anomaly detector is not available.")))
    j = j.withColumn("error", F.coalesce("error", *problems))
    if detector is None:
        return j.drop("_n", "_a")
    scored = detector.score(j, "actual_load_mw", "prediction")
    ok = F.col("error").isNull() & (F.col("_a") == F.col("_n"))
    return scored.select(
        "request_id", "record_idx", "prediction", "actual_load_mw", "error",
        F.when(ok, F.col("anomaly_score")).alias("anomaly_score"),
        F.when(ok, F.col("is_anomaly")).alias("is_anomaly"),
    )


def request_table(rows: DataFrame, features: Sequence[str], *, request_size: int = 100, rn: str = "rn",
                  actual: str | None = None) -> DataFrame:
    """Build request records from numbered feature rows (``rn`` 0-based)."""

    return rows.select(
        (F.col(rn) / request_size).cast("long").alias("request_id"),
        (F.col(rn) % request_size).cast("long").alias("record_idx"),
        features_to_map(features).alias("features"),
        (F.col(actual).cast("double") if actual else F.lit(None).cast("double")).alias("actual_load_mw"),
    )


def payload_records(supervised: DataFrame, features: Sequence[str], n: int = 3) -> DataFrame:
    """Q5: the last ``n`` supervised rows (zone, timestamp order) as request records.

    The naive residual pair uses the target as actual and current load as prediction.
    """

    tail = tail_rows(supervised, n)
    return tail.select(
        "zone", "timestamp",
        features_to_map(features).alias("features"),
        F.col(TARGET).alias("actual_load_mw"),
        F.col("load_mw").alias("predicted_load_mw"),
    )


def payload_json(records: DataFrame) -> DataFrame:
    """One JSON line per record for each of the three request kinds."""

    def checked(name: Column, v: Column) -> Column:
        message = F.concat(F.lit("Feature value must be finite: "), name)
        return F.when(_finite(v), v).otherwise(F.raise_error(message).cast("double"))

    feats = F.transform_values("features", checked)
    return records.select(
        "zone", "timestamp",
        to_json_safe(feats.alias("features")).alias("forecast_record"),
        to_json_safe(finite_or_null("actual_load_mw").alias("actual_load_mw"),
                     finite_or_null("predicted_load_mw").alias("predicted_load_mw")).alias("anomaly_record"),
        to_json_safe(feats.alias("features")).alias("batch_record"),
    )
