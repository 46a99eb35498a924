"""Q6: stateless stream scoring with Structured Streaming.

The reference answers requests one HTTP call at a time; here request records
arrive as files, are scored with the same static expressions as the batch
path (model and detector parameters are literals, no state), and are written
by a file sink with a checkpoint in the shared checkpoint folder, so a
restarted query resumes exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, LongType, MapType, StringType, StructField, StructType

from wattlane.functions.jsonsafe import map_to_features
from wattlane.operators.detectors import ResidualZScoreDetector
from wattlane.operators.ridge import RidgeModel

STREAM_SCHEMA = StructType([
    StructField("request_id", LongType()),
    StructField("record_idx", LongType()),
    StructField("features", MapType(StringType(), DoubleType())),
    StructField("actual_load_mw", DoubleType()),
])


def score_stream(stream: DataFrame, model: RidgeModel, detector: ResidualZScoreDetector | None) -> DataFrame:
    """Per-record prediction, ``error`` and optional anomaly score; no cross-record state.

    A record is an answer of its own here, so a model feature that it lacks, or
    that isn't finite, makes it an error instead of a prediction.
    """

    unusable = [
        F.when(F.coalesce(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(True)), F.lit(name))
        for name, v in ((n, F.try_element_at("features", F.lit(n))) for n in model.feature_names)
    ]
    missing = F.concat_ws(", ", *unusable)
    error = F.when(missing != "", F.concat(F.lit("Missing required features: "), missing, F.lit(".")))
    expanded = stream.select(
        F.struct("request_id", "record_idx", "actual_load_mw").alias("_req"), error.alias("_error"),
        *map_to_features("features", model.feature_names))
    out = expanded.select("_req.*", F.when(F.col("_error").isNull(), model.prediction_column()).alias("prediction"),
                          F.col("_error").alias("error"))
    if detector is not None:
        scored = detector.score(out, "actual_load_mw", "prediction")
        has = F.col("actual_load_mw").isNotNull() & F.col("error").isNull()
        out = scored.withColumn("anomaly_score", F.when(has, F.col("anomaly_score"))).withColumn(
            "is_anomaly", F.when(has, F.col("is_anomaly"))
        )
    return out


def run_stream_scoring(
    spark: SparkSession,
    source_dir: str,
    sink_dir: str,
    checkpoint_dir: str,
    model: RidgeModel,
    detector: ResidualZScoreDetector | None = None,
    *,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    reader = spark.readStream.schema(STREAM_SCHEMA).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    scored = score_stream(reader.load(source_dir), model, detector)
    return (
        scored.writeStream.format("parquet")
        .option("path", sink_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
