"""Registered queries over JSON request documents, with their DuckDB SQL.

Panel rows are written as documents of up to 100 records, with faults planted
by integer rules on the row's and the document's number. A third of the
documents has no request_id, the others share five.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.operators.detectors import ResidualZScoreDetector
from wattlane.operators.ordering import chronological_row_number
from wattlane.operators.ridge import RidgeModel
from wattlane.plans.documents import answer_documents, answered_records, judge_documents
from wattlane.session import ensure_checkpoint_dir
from wattlane.sources.adapters import events_panel
from wattlane.streaming.documents import run_document_stream

MODEL = RidgeModel(["load_mw", "temperature_c"], [0.5, 2.0], 1.0, {"load_mw": 10.0, "temperature_c": 4.0})
DETECTOR = ResidualZScoreDetector(1.5, residual_mean_=1.0, residual_std_=20.0)


def _round(c: str) -> Column:
    x = F.col(c)
    return F.round(x + (F.abs(x) * F.lit(1e-12) + F.lit(1e-9)), 6).alias(c)


def _json_number(name: str) -> Column:
    text = F.to_json(F.struct(F.col(name).alias("x")))
    return F.substring(text, 6, F.length(text) - 6)


def _documents(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """(doc, value): panel rows in chronological order as documents of 100 records."""

    rn, doc = F.col("rn"), F.col("doc")
    p = chronological_row_number(events_panel(spark, sf)).withColumn("doc", F.floor(rn / 100))
    number, temperature = _json_number("load_mw"), _json_number("temperature_c")
    load = F.when(rn % 1013 == 7, F.lit('"many"')).when(rn % 1019 == 8, F.lit("null")).when(
        rn % 7 == 2, F.concat(F.lit('" '), number, F.lit('"'))).otherwise(number)  # quoted numbers are numbers
    extra = F.when(rn % 1021 == 9, F.lit(', "extra": 1')).otherwise("")
    if kind == "anomaly":
        record = F.format_string('{"actual_load_mw": %s, "predicted_load_mw": %s%s}', load, temperature, extra)
    else:
        name = F.when(rn % 1009 == 5, F.lit(" \\t")).otherwise("load_mw")
        warm = F.when((rn % 10 == 3) | (doc % 9 == 8), F.lit("")).otherwise(F.concat(F.lit(', "temperature_c": '), temperature))
        actual = F.when((doc % 3 == 1) | (rn % 997 == 11), F.lit("")).otherwise(F.concat(F.lit(', "actual_load_mw": '), number))
        record = F.format_string('{"features": {"%s": %s%s}%s%s}', name, load, warm, actual, extra)
    rows = p.select("doc", "rn", record.alias("record")).groupBy("doc").agg(
        F.sort_array(F.collect_list(F.struct("rn", "record"))).alias("rows"))  # a document has 100 rows at most
    records = F.array_join(F.transform("rows", lambda r: r["record"]), ", ")
    who = F.when(doc % 3 == 0, F.lit("")).otherwise(F.format_string('"request_id": "r%d", ', doc % 5))
    note = F.when(doc % 50 == 49, F.lit(', "note": "x"')).otherwise("")
    whole = F.when(doc % 59 == 58, F.lit('[1, 2')).when(doc % 53 == 52, F.lit('{"records": []}')).otherwise(
        F.format_string('{%s"records": [%s]%s}', who, records, note))
    return rows.select("doc", whole.alias("value"))


def request_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Q4: what is wrong with every batch document, and with which of its records."""

    judged = judge_documents(_documents(spark, sf, "batch"), "batch")
    return judged.select("doc", "request_id", "n_records", F.col("reason").isNull().alias("valid"), "reason", "reason_record")


def document_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """Q1: one row per record of the answered documents."""

    answers = answer_documents(_documents(spark, sf, "batch"), "batch", MODEL, DETECTOR)
    return answered_records(answers).select("doc", "request_id", "record_idx", _round("prediction"), _round("anomaly_score"),
                                            F.coalesce("is_anomaly", F.lit(False)).alias("is_anomaly")).drop("value")


def document_status(spark: SparkSession, sf: str) -> DataFrame:
    """Q3: status and detail of every batch document, without a detector."""

    answers = answer_documents(_documents(spark, sf, "batch"), "batch", MODEL)
    return answers.select("doc", "request_id", F.col("status").cast("long").alias("status"), "detail",
                          F.coalesce(F.array_size("predictions"), F.lit(0)).cast("long").alias("n_predictions"))


def document_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Q2: scores of the pairs of every valid document."""

    answers = answer_documents(_documents(spark, sf, "anomaly"), "anomaly", detector=DETECTOR)
    return answered_records(answers).select("doc", "request_id", "record_idx", _round("anomaly_score"), "is_anomaly")


def document_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Q6: the batch documents as a stream of JSON files; answered records and rejected documents, by number."""

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/documents-{uuid.uuid4().hex}"
    _documents(spark, sf, "batch").select("value").write.text(f"{root}/source")
    run_document_stream(spark, f"{root}/source", f"{root}/answers", f"{root}/rejects", f"{root}/checkpoint", "batch",
                        MODEL, DETECTOR).awaitTermination()
    schema = "source STRING, value STRING, request_id STRING, {}batch INT"
    answers = spark.read.schema(schema.format("record_idx LONG, prediction DOUBLE, anomaly_score DOUBLE, is_anomaly BOOLEAN, "))
    rejects = spark.read.schema(schema.format("status INT, detail STRING, "))
    good = answers.parquet(f"{root}/answers").groupBy("request_id").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("prediction").alias("total"))
    bad = rejects.parquet(f"{root}/rejects").groupBy("request_id", "detail").agg(F.count(F.lit(1)).alias("rows"))
    good = good.select("request_id", F.lit(None).cast("string").alias("detail"), "rows", _round("total"))
    return good.unionByName(bad.withColumn("total", F.lit(None).cast("double")))


QUERIES = {
    "request_documents": request_documents,
    "document_forecast": document_forecast,
    "document_status": document_status,
    "document_pairs": document_pairs,
    "document_stream": document_stream,
}

_ROWS = """panel AS (
  SELECT ts AS "timestamp", event_type AS zone, CAST(value AS DOUBLE) AS load_mw,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS temperature_c FROM events),
rows AS (
  SELECT load_mw, temperature_c, rn, rn // 100 AS doc, rn % 100 AS record_idx
  FROM (SELECT *, row_number() OVER (ORDER BY "timestamp", zone) - 1 AS rn FROM panel)),
docs AS (
  SELECT doc, CASE WHEN doc % 3 = 0 OR doc % 59 = 58 OR doc % 53 = 52 THEN NULL ELSE 'r' || (doc % 5) END AS request_id,
    CASE WHEN doc % 59 = 58 OR doc % 53 = 52 THEN 0 ELSE count(*) END AS n_records,
    {problem}
    count(*) FILTER (NOT (doc % 3 = 1 OR rn % 997 = 11)) AS actuals, count(*) AS n
  FROM rows GROUP BY doc)"""
_BATCH = _ROWS.format(problem="""min(CASE WHEN rn % 1021 = 9 THEN {'i': record_idx, 'r': 'unknown_field'}
      WHEN rn % 1009 = 5 THEN {'i': record_idx, 'r': 'blank_feature_name'}
      WHEN rn % 1013 = 7 OR rn % 1019 = 8 THEN {'i': record_idx, 'r': 'non_finite_feature'} END) AS bad,""") + """,
judged AS (
  SELECT *, CASE WHEN doc % 59 = 58 THEN 'malformed' WHEN doc % 53 = 52 THEN 'no_records'
    WHEN doc % 50 = 49 THEN 'unknown_field' WHEN bad IS NOT NULL THEN bad.r
    WHEN actuals > 0 AND actuals < n THEN 'partial_actuals' END AS reason FROM docs)"""
_PAIRS = _ROWS.format(problem="""bool_or(rn % 1021 = 9 OR rn % 1013 = 7 OR rn % 1019 = 8) AS bad,""")
_PREDICTION = """1.0::DOUBLE + 0.5::DOUBLE * load_mw
      + 2.0::DOUBLE * CASE WHEN rn % 10 = 3 THEN 4.0::DOUBLE ELSE temperature_c END"""


def _rounded(x: str) -> str:
    return f"round(({x}) + (abs({x}) * 1e-12 + 1e-9), 6)"


_ANSWERED = f"""{_BATCH},
answered AS (
  SELECT doc, request_id, record_idx, {_PREDICTION} AS prediction, doc % 3 <> 1 AS scored, load_mw
  FROM rows JOIN judged USING (doc) WHERE reason IS NULL AND doc % 9 <> 8)"""
_DETAIL = """CASE reason WHEN 'malformed' THEN 'The document is not a JSON object with a list of records.'
    WHEN 'unknown_field' THEN 'Unknown fields are not allowed.' WHEN 'no_records' THEN 'At least one record is required.'
    WHEN 'blank_feature_name' THEN 'Feature names must be non-empty.'
    WHEN 'non_finite_feature' THEN 'Feature values must be finite.'
    WHEN 'partial_actuals' THEN 'actual_load_mw must be provided for all records or no records.'
    ELSE CASE WHEN doc % 9 = 8 THEN 'Missing required features: temperature_c.' END END"""

ORACLES = {
    "request_documents": f"""WITH {_BATCH}
SELECT doc, request_id, n_records, reason IS NULL AS valid, reason,
  CASE WHEN doc % 59 <> 58 AND doc % 53 <> 52 THEN bad.i END AS reason_record FROM judged""",
    "document_forecast": f"""WITH {_ANSWERED},
scores AS (SELECT *, CASE WHEN scored THEN abs((load_mw - prediction - 1.0) / 20.0) END AS score FROM answered)
SELECT doc, request_id, record_idx, {_rounded('prediction')} AS prediction, {_rounded('score')} AS anomaly_score,
  coalesce(score >= 1.5, false) AS is_anomaly FROM scores""",
    "document_status": f"""WITH {_BATCH},
said AS (SELECT *, {_DETAIL} AS said FROM judged)
SELECT doc, request_id, CASE WHEN said IS NOT NULL THEN 422 WHEN doc % 3 <> 1 THEN 503 ELSE 200 END::BIGINT AS status,
  coalesce(said, CASE WHEN doc % 3 <> 1 THEN 'Anomaly detector is unavailable.' END) AS detail,
  CASE WHEN said IS NULL AND doc % 3 = 1 THEN n ELSE 0 END AS n_predictions FROM said""",
    "document_pairs": f"""WITH {_PAIRS},
scores AS (
  SELECT doc, request_id, record_idx, abs((load_mw - temperature_c - 1.0) / 20.0) AS score FROM rows JOIN docs USING (doc)
  WHERE NOT bad AND doc % 59 <> 58 AND doc % 53 <> 52 AND doc % 50 <> 49)
SELECT doc, request_id, record_idx, {_rounded('score')} AS anomaly_score, score >= 1.5 AS is_anomaly FROM scores""",
    "document_stream": f"""WITH {_ANSWERED},
good AS (SELECT request_id, count(*) AS rows, sum(prediction) AS total FROM answered GROUP BY 1),
said AS (SELECT request_id, {_DETAIL} AS detail FROM judged),
bad AS (SELECT request_id, detail, count(*) AS rows FROM said WHERE detail IS NOT NULL GROUP BY 1, 2)
SELECT request_id, NULL::VARCHAR AS detail, rows, {_rounded('total')} AS total FROM good
UNION ALL SELECT request_id, detail, rows, NULL::DOUBLE FROM bad""",
}
