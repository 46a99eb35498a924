"""Q6: a stream of JSON request documents with two sinks, answers and rejects.

The plan of a micro-batch is that of ``plans.documents``, which has no state and
no shuffle. Each batch is written to folders named by its id, in place of what a
failed attempt may have left there; so a batch that is run again after a failure
neither loses nor repeats a document.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wattlane.operators.ridge import RidgeModel
from wattlane.plans.documents import Detector, answer_documents, answered_records


def run_document_stream(
    spark: SparkSession,
    source_dir: str,
    answers_dir: str,
    rejects_dir: str,
    checkpoint_dir: str,
    kind: str = "batch",
    model: RidgeModel | None = None,
    detector: Detector | None = None,
    *,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Answer the documents (one JSON object a line) of ``source_dir``; stops when all of them are answered.

    ``answers_dir`` has a row per record (source, line's text, request_id,
    record_idx, prediction, anomaly_score, is_anomaly), ``rejects_dir`` one per
    rejected document with status and detail; both are partitioned by ``batch``.
    """

    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(source_dir).select("value", F.col("_metadata.file_name").alias("source"))

    def write(batch: DataFrame, batch_id: int) -> None:
        answers = answer_documents(batch, kind, model, detector).persist(StorageLevel.MEMORY_AND_DISK)  # both sinks read them
        try:
            records = answered_records(answers)
            records.write.mode("overwrite").parquet(f"{answers_dir}/batch={batch_id}")
            rejected = answers.where("status <> 200").select("source", "value", "request_id", "status", "detail")
            rejected.write.mode("overwrite").parquet(f"{rejects_dir}/batch={batch_id}")
        finally:
            answers.unpersist()

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
