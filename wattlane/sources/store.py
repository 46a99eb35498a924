"""An append-only store of fitted models and detectors, by id and version.

Under one path lie two folders. ``models`` has a row per stored version (kind,
time and metadata as JSON), partitioned by model_id and version; it is written
last, so a version is there as a whole or not at all. ``parameters`` has the
tables, in folders of the same names, with the column types they were fitted
with; tables of a row per zone are written and read as they are, in many files.
Nothing is ever overwritten: of two writers that take the same number, the
second one takes the next.
"""

from __future__ import annotations

import json
from dataclasses import asdict, replace
from datetime import UTC, datetime
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattlane.operators.detectors import ResidualZScoreDetector, RobustResidualDetector
from wattlane.operators.forest import ForestModel
from wattlane.operators.isoforest import NODE_SCHEMA, IsolationForestModel
from wattlane.operators.ridge import RidgeModel, ZoneRidgeModel
from wattlane.session import folder_exists

MODELS = "model_id STRING, version LONG, kind STRING, created_at STRING, metadata STRING"
Stored = RidgeModel | ZoneRidgeModel | ForestModel | ResidualZScoreDetector | RobustResidualDetector | IsolationForestModel


def _plain(obj: Any, *tables: str) -> dict[str, Any]:
    """The fields of a dataclass that are no tables."""

    return {k: getattr(obj, k) for k in obj.__dataclass_fields__ if k not in tables}


def _dismantled(spark: SparkSession, obj: Stored) -> tuple[str, dict[str, Any], DataFrame | None]:
    """Kind, metadata and table of a model or detector."""

    if isinstance(obj, RidgeModel):
        rows = [(i, f, float(c), obj.medians.get(f)) for i, (f, c) in enumerate(zip(obj.feature_names, obj.coefficients, strict=True))]
        table = spark.createDataFrame(rows, "position INT, feature STRING, coefficient DOUBLE, median DOUBLE")
        return "ridge", _plain(obj, "feature_names", "coefficients", "medians"), table
    if isinstance(obj, ZoneRidgeModel):
        return "zone_ridge", _plain(obj, "coefficients"), obj.coefficients
    if isinstance(obj, ForestModel):
        return "random_forest", _plain(obj, "trees"), obj.trees
    if isinstance(obj, IsolationForestModel):
        return "isolation_forest", _plain(obj, "nodes"), spark.createDataFrame(obj.nodes, NODE_SCHEMA)
    kind = "residual_zscore" if isinstance(obj, ResidualZScoreDetector) else "robust_residual"
    if obj.by and obj.params_ is None or not obj.by and None in [v for k, v in asdict(replace(obj, params_=None)).items() if k.startswith("residual_")]:
        raise ValueError("detector must be fitted before saving.")
    return kind, _plain(obj, "params_"), obj.params_


def versions(spark: SparkSession, path: str, model_id: str | None = None) -> DataFrame:
    """model_id, version, kind, created_at, metadata of all stored versions, or of those of one model."""

    if folder_exists(spark, f"{path}/models"):
        stored = spark.read.schema(MODELS).parquet(f"{path}/models")
    else:
        stored = spark.createDataFrame([], MODELS)
    return stored if model_id is None else stored.where(F.col("model_id") == model_id)


def put(spark: SparkSession, path: str, model_id: str, obj: Stored, tries: int = 5) -> int:
    """Store a fitted model or detector as the next version of ``model_id``; returns the version, 1 at first."""

    if not model_id or not model_id.strip() or "/" in model_id or "=" in model_id:
        raise ValueError("model_id must be a non-blank name without '/' or '='.")
    kind, metadata, table = _dismantled(spark, obj)
    if table is not None:
        metadata = {**metadata, "_schema": table.schema.json()}
    text = json.dumps(metadata)
    for _ in range(tries):
        version = (versions(spark, path, model_id).agg(F.max("version")).first()[0] or 0) + 1
        folder = f"model_id={model_id}/version={version}"
        try:
            if table is not None:
                table.write.parquet(f"{path}/parameters/{folder}")
            row = [(kind, datetime.now(tz=UTC).isoformat(), text)]
            spark.createDataFrame(row, "kind STRING, created_at STRING, metadata STRING").coalesce(1).write.parquet(f"{path}/models/{folder}")
            return version
        except AnalysisException as exc:  # another writer took this number
            if exc.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            if versions(spark, path, model_id).where(F.col("version") == version).isEmpty():
                raise ValueError(f"Version {version} of {model_id} is half written; remove {path}/parameters/{folder}.") from exc
    raise RuntimeError(f"No free version of {model_id} in {tries} tries.")


def get(spark: SparkSession, path: str, model_id: str, version: int | None = None) -> Stored:
    """A stored model or detector: its latest version, or the one asked for. An unknown one raises ``KeyError``."""

    stored = versions(spark, path, model_id)
    if version is not None:
        stored = stored.where(F.col("version") == version)
    row = stored.orderBy(F.col("version").desc()).first()
    if row is None:
        raise KeyError(f"No version {version or ''} of {model_id} in {path}.".replace("  ", " "))
    metadata = json.loads(row["metadata"])
    schema = metadata.pop("_schema", None)
    folder = f"{path}/parameters/model_id={model_id}/version={row['version']}"
    table = spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(folder) if schema else None
    kind = row["kind"]
    if kind == "ridge":  # a row per feature
        rows = sorted(table.collect(), key=lambda r: r["position"])
        return RidgeModel([r["feature"] for r in rows], [r["coefficient"] for r in rows],
                          medians={r["feature"]: r["median"] for r in rows}, **metadata)
    if kind == "zone_ridge":
        return ZoneRidgeModel(coefficients=table, **metadata)
    if kind == "random_forest":
        return ForestModel(trees=table, **metadata)
    if kind == "isolation_forest":  # bounded: trees * (2 * 256 - 1) nodes
        return IsolationForestModel(nodes=table.toPandas(), **metadata)
    metadata["by"] = tuple(metadata["by"])
    cls = ResidualZScoreDetector if kind == "residual_zscore" else RobustResidualDetector
    return cls(params_=table, **metadata)
