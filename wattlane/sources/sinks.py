"""Sinks through Spark writers (work on any cluster file system).

Metric documents are small driver-side dicts; they are written as one JSON
text file with sorted keys and NaN/inf turned into null.  Tables (scores,
fold metrics, parameters) are written with the DataFrame writers.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from wattlane.functions.jsonsafe import json_safe
from wattlane.operators.validate import csv_timestamps
from wattlane.schema import CANONICAL_COLUMNS


def metrics_json(metrics: dict[str, Any]) -> str:
    return json.dumps(json_safe(metrics), indent=2, sort_keys=True, allow_nan=False)


def write_json_metrics(spark: SparkSession, metrics: dict[str, Any], path: str) -> str:
    """One JSON document (sorted keys, NaN/inf as null) written as a text file."""

    text = metrics_json(metrics)
    spark.createDataFrame([(text,)], "value STRING").coalesce(1).write.mode("overwrite").text(path)
    return path


def read_json_metrics(spark: SparkSession, path: str) -> dict[str, Any]:
    text = "\n".join(r["value"] for r in spark.read.text(path).collect())
    return json.loads(text)


def write_canonical(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """S3: six canonical columns, in order; a CSV has a header, doubled quotes and whole fractions of seconds."""

    out = df.select(*CANONICAL_COLUMNS)
    if fmt == "csv":
        texts = csv_timestamps(out)
        texts.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
        return path
    out.write.mode("overwrite").format(fmt).save(path)
    return path


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.format(fmt).save(path)
    return path
