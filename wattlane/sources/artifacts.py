"""S3, S5-S7 artefacts as tables: detector parameters, forest nodes, canonical files, payloads.

Everything is written with Spark writers, so paths may live on any file
system the cluster reads.  Parameter tables are tiny (one row per zone or
per tree node), so reading them back to the driver is bounded.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.operators.detectors import ResidualZScoreDetector, RobustResidualDetector
from wattlane.operators.isoforest import NODE_SCHEMA, IsolationForestModel
from wattlane.operators.normalize import NormalizeConfig, normalize_export
from wattlane.operators.validate import read_export_csv, read_panel_csv
from wattlane.sources.sinks import write_canonical

Detector = ResidualZScoreDetector | RobustResidualDetector | IsolationForestModel


def save_detector(spark: SparkSession, detector: Detector, path: str) -> str:
    """A parameter table (residual detectors) or a node table plus metadata (forest)."""

    if isinstance(detector, IsolationForestModel):
        meta = json.dumps({"kind": "isolation_forest", "feature_names": detector.feature_names,
                           "medians": detector.medians, "psi": detector.psi, "trees": detector.trees,
                           "contamination": detector.contamination, "offset": detector.offset})
        spark.createDataFrame(detector.nodes, NODE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        spark.createDataFrame([(meta,)], "metadata STRING").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
        return path
    kind = "residual_zscore" if isinstance(detector, ResidualZScoreDetector) else "robust_residual"
    if detector.by:
        params = detector.params_
        if params is None:
            raise ValueError("detector must be fitted before saving.")
        center, scale = ("residual_mean", "residual_std") if kind == "residual_zscore" else ("residual_median", "residual_mad")
        pooled = (detector.residual_mean_, detector.residual_std_) if kind == "residual_zscore" else (
            detector.residual_median_, detector.residual_mad_)
        table = params.select(F.struct(*detector.by).alias("group_key"),  # typed, a row per group in as many files as there are
                              F.col(center).alias("center"), F.col(scale).alias("scale"))
    else:
        center = detector.residual_mean_ if kind == "residual_zscore" else detector.residual_median_
        scale = detector.residual_std_ if kind == "residual_zscore" else detector.residual_mad_
        if center is None or scale is None:
            raise ValueError("detector must be fitted before saving.")
        pooled = (center, scale)
        table = spark.createDataFrame([(None, float(center), float(scale))], "group_key STRING, center DOUBLE, scale DOUBLE").coalesce(1)
    meta = json.dumps({"kind": kind, "threshold": detector.threshold, "by": list(detector.by), "pooled": pooled})
    table.withColumn("metadata", F.lit(meta)).write.mode("overwrite").parquet(f"{path}/params")
    return path


def load_detector(spark: SparkSession, path: str) -> Detector:
    try:
        meta_rows = spark.read.parquet(f"{path}/meta").collect()
    except Exception:
        meta_rows = []
    if meta_rows:
        meta = json.loads(meta_rows[0]["metadata"])
        nodes = spark.read.parquet(f"{path}/nodes").toPandas()
        return IsolationForestModel(meta["feature_names"], meta["medians"], pd.DataFrame(nodes), psi=meta["psi"],
                                    trees=meta["trees"], contamination=meta["contamination"], offset=meta["offset"])
    params = spark.read.parquet(f"{path}/params")
    meta = json.loads(params.first()["metadata"])
    by = tuple(meta["by"])
    if meta["kind"] == "residual_zscore":
        det: Detector = ResidualZScoreDetector(meta["threshold"], by=by)
        names = ("residual_mean", "residual_std")
    else:
        det = RobustResidualDetector(meta["threshold"], by=by)
        names = ("residual_median", "residual_mad")
    if by:
        det.params_ = params.select(
            *[F.col(f"group_key.{b}").alias(b) for b in by], F.col("center").alias(names[0]), F.col("scale").alias(names[1]))
    for name, value in zip(names, meta["pooled"], strict=True):
        setattr(det, name + "_", value)
    return det


def normalize_export_file(spark: SparkSession, input_path: str, output_path: str, cfg: NormalizeConfig) -> str:
    """S2 -> P1-P5 -> S3 -> S1: read an export, write the canonical CSV, read it back through validation."""

    normalized = normalize_export(read_export_csv(spark, input_path), cfg)
    write_canonical(normalized.orderBy("timestamp", "zone"), output_path)
    read_panel_csv(spark, output_path).count()
    return output_path


def save_payload(records_json: DataFrame, path: str) -> str:
    """Request payload lines (see ``plans.requests.payload_json``) as JSON records."""

    records_json.coalesce(1).write.mode("overwrite").json(path)
    return path
