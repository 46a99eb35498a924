"""Anomaly method comparison and threshold / contamination tuning.

The reference refits a detector for every grid value.  Detector parameters
do not depend on the threshold (or, for the forest, on the contamination,
which only moves the offset), so here every method is fitted once.  No row is
copied for the grid: a score lies between two of its values, one aggregate
counts the rows by that place and label, and the confusion matrix of a candidate
adds up the places it flags.  Selection is the first maximum of macro F1.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlane.functions.missing import known
from wattlane.operators.detectors import ResidualZScoreDetector, RobustResidualDetector, flagged as flagged_at
from wattlane.operators.isoforest import fit_isolation_forest, offsets_for
from wattlane.operators.metrics import classification_from_counts, confusion_columns
from wattlane.operators.splits import train_test_split, train_validation_test_split
from wattlane.plans.backtest import check_single_zone
from wattlane.plans.train import fit_forecaster, prepare_supervised
from wattlane.operators.features import FeatureConfig
from wattlane.session import cut_lineage
from wattlane.schema import CONTAMINATION_GRID, DEFAULT_THRESHOLDS, METHODS, ROBUST_GRID, ZSCORE_GRID

LABEL = "actual_anomaly"


def _check_methods(methods: tuple[str, ...]) -> None:
    bad = [m for m in methods if m not in METHODS]
    if bad:
        raise ValueError(f"Unsupported anomaly methods: {', '.join(bad)}.")
    if not methods:
        raise ValueError("At least one anomaly method is required.")


def grid_confusion(
    scored: DataFrame, grid: list[float], score_col: str, flag_rule: str, labels: bool
) -> list[dict[str, Any]]:
    """Candidate metrics for every grid value, from one count by place in the grid and label.

    ``flag_rule`` is ``ge`` (score >= value, residual thresholds) or ``lt``
    (score < value, forest offsets). A missing score is never flagged.
    """

    spark = scored.sparkSession
    label = [F.coalesce(F.col(LABEL), F.lit(False)).alias("_label")] if labels else []
    places = scored.groupBy(grid_place(F.col(score_col), grid, flag_rule).alias("_place"), *label).agg(
        F.count(F.lit(1)).alias("_rows"))  # one row more than the grid has, by label
    flagged = places.crossJoin(F.broadcast(spark.createDataFrame(
        [(i, rank) for i, rank in enumerate(grid_ranks(grid, flag_rule))], "grid_idx INT, rank INT")))
    flagged = flagged.withColumn("_flag", F.col("_place") > F.col("rank"))

    def rows_where(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("_rows"))), F.lit(0))

    aggs = [rows_where(F.col("_flag")).alias("detected_count")]
    if labels:
        actual, flag = F.col("_label"), F.col("_flag")
        aggs += [rows_where(~actual & ~flag).alias("tn"), rows_where(~actual & flag).alias("fp"),
                 rows_where(actual & ~flag).alias("fn"), rows_where(actual & flag).alias("tp"),
                 rows_where(actual).alias("labeled_anomaly_count")]
    rows = flagged.groupBy("grid_idx").agg(*aggs)
    if labels:
        rows = rows.select("*", *classification_from_counts(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))
    return [r.asDict() for r in sorted(rows.collect(), key=lambda r: r["grid_idx"])]


def grid_place(score: Column, grid: Sequence[float], flag_rule: str = "ge") -> Column:
    """How many values of the grid flag a score; none flags a missing one."""

    x = known(score)
    place = F.lit(0)
    for v in grid:
        place = place + F.when(x >= v if flag_rule == "ge" else x < v, 1).otherwise(0)
    return place


def grid_ranks(grid: Sequence[float], flag_rule: str = "ge") -> list[int]:
    """By grid value: a score is flagged by it just when its ``grid_place`` is above this number."""

    return [sum(w < v if flag_rule == "ge" else w > v for w in grid) for v in grid]


def payload(r: dict[str, Any], labels: bool) -> dict[str, Any]:
    out = {"detected_count": r["detected_count"], "labeled_anomaly_count": None, "precision": None,
           "recall": None, "macro_f1": None, "confusion_matrix": None}
    if labels:
        out.update({
            "labeled_anomaly_count": r["labeled_anomaly_count"], "precision": r["precision"],
            "recall": r["recall"], "macro_f1": r["macro_f1"],
            "confusion_matrix": [[r["tn"], r["fp"]], [r["fn"], r["tp"]]],
        })
    return out


def select_best(candidates: list[dict[str, Any]], labels: bool) -> int:
    """Index of the first maximum macro F1 (missing counts as -1); first entry without labels."""

    if not candidates:
        raise ValueError("At least one candidate is required.")
    if not labels:
        return 0
    best, best_val = 0, None
    for i, c in enumerate(candidates):
        v = c.get("macro_f1")
        v = -1.0 if v is None else v
        if best_val is None or v > best_val:
            best, best_val = i, v
    return best


@dataclass
class AnomalyConfig:
    forecast_horizon: int = 24
    model: str = "ridge"
    split_method: str = "chronological"
    test_size: float = 0.2
    validation_size: float = 0.2
    methods: tuple[str, ...] = METHODS
    random_state: int = 42
    residual_zscore_threshold: float = 3.0
    robust_residual_threshold: float = 3.5
    isolation_contamination: float | str = "auto"
    strict_single_zone: bool = True
    feature: FeatureConfig | None = None
    excluded_columns: tuple[str, ...] = ()  # numeric columns that are no features
    align_labels: str = "timestamp"  # "target": compare the label at t+h with the residual of load[t+h]

    def __post_init__(self) -> None:
        if self.align_labels not in {"timestamp", "target"}:
            raise ValueError("align_labels must be 'timestamp' or 'target'.")

    def feature_config(self) -> FeatureConfig:
        base = self.feature or FeatureConfig(forecast_horizon=self.forecast_horizon)
        if self.align_labels == "target":
            from dataclasses import replace

            return replace(base, lead_columns=("is_anomaly",))
        return base


@dataclass
class _Prepared:
    frame: DataFrame
    features: list[str]
    counts: dict[str, int]
    labels: bool
    extra: dict[str, Any] = field(default_factory=dict)


def _prepare(panel: DataFrame, cfg: AnomalyConfig, three_way: bool) -> _Prepared:
    _check_methods(cfg.methods)
    fc = cfg.feature_config() if "is_anomaly" in panel.columns else (cfg.feature or FeatureConfig(forecast_horizon=cfg.forecast_horizon))
    sup = prepare_supervised(panel, fc, cfg.excluded_columns)
    if "target_is_anomaly" in sup.frame.columns:  # align_labels="target": the label of load[t+h]
        sup.frame = sup.frame.withColumn("is_anomaly", F.col("target_is_anomaly")).drop("target_is_anomaly")
    numbered = "isolation_forest" in cfg.methods  # it draws its samples by position
    if three_way:
        split = train_validation_test_split(
            sup.frame, validation_size=cfg.validation_size, test_size=cfg.test_size,
            split_method=cfg.split_method, random_state=cfg.random_state, rows=sup.rows,
            numbered=numbered,
        )
    else:
        split = train_test_split(sup.frame, cfg.test_size, split_method=cfg.split_method,
                                 random_state=cfg.random_state, rows=sup.rows, numbered=numbered)
    extra = {"center": sup.means} if cfg.model == "ridge" else {}
    model = fit_forecaster(split.part("train"), sup.features, fc.target_column, cfg.model,
                           forecast_horizon=cfg.forecast_horizon, random_state=cfg.random_state, **extra)
    frame = model.predict(split.frame).withColumn("residual", F.col(fc.target_column) - F.col("prediction"))
    labels = "is_anomaly" in frame.columns
    if labels:
        frame = frame.withColumn(LABEL, F.col("is_anomaly").cast("boolean"))
    # every method and grid value reads this frame: write it once to the shared checkpoint folder
    prepared = _Prepared(cut_lineage(frame), sup.features, split.counts, labels)
    sup.release()
    return prepared


def _residual_detector(method: str, threshold: float):
    return ResidualZScoreDetector(threshold) if method == "residual_zscore" else RobustResidualDetector(threshold)


def _write(panel: DataFrame, doc: dict[str, Any], metrics_dir: str | None, key: str) -> dict[str, Any]:
    if metrics_dir:
        from wattlane.sources.sinks import write_json_metrics

        write_json_metrics(panel.sparkSession, doc, f"{metrics_dir}/{key}")
    return doc


def run_anomaly_evaluation(panel: DataFrame, cfg: AnomalyConfig | None = None, metrics_dir: str | None = None) -> dict[str, Any]:
    """Each method fitted on train, scored on test; one aggregate grouped by method."""

    cfg = cfg or AnomalyConfig()
    prep = _prepare(panel, cfg, three_way=False)
    train = prep.frame.where(F.col("split") == "train")
    test = prep.frame.where(F.col("split") == "test")
    scored_parts, configs = [], {}
    for method in cfg.methods:
        if method in ("residual_zscore", "robust_residual"):
            thr = cfg.residual_zscore_threshold if method == "residual_zscore" else cfg.robust_residual_threshold
            det = _residual_detector(method, thr).fit_residuals(train, "residual")
            scored = det.score_residuals(test, "residual")
            configs[method] = {"threshold": thr}
        else:
            forest = fit_isolation_forest(train, prep.features, contamination=cfg.isolation_contamination,
                                          random_state=cfg.random_state, rows=prep.counts["train"])
            scored = forest.score(test)
            configs[method] = {"contamination": cfg.isolation_contamination, "feature_count": len(prep.features)}
        cols = ["anomaly_score", "is_anomaly"] + ([LABEL] if prep.labels else [])
        scored_parts.append(scored.select(F.lit(method).alias("method"), *cols))
    union = scored_parts[0]
    for p in scored_parts[1:]:
        union = union.unionByName(p)
    aggs = [F.count_if("is_anomaly").alias("detected_count")]
    if prep.labels:
        aggs += confusion_columns(F.col(LABEL), F.col("is_anomaly")) + [F.count_if(F.col(LABEL)).alias("labeled_anomaly_count")]
    summary = union.groupBy("method").agg(*aggs)
    if prep.labels:
        summary = summary.select("*", *classification_from_counts(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))
    results = {}
    for r in summary.collect():
        d = r.asDict()
        res: dict[str, Any] = {"method": d["method"], "config": configs[d["method"]],
                               "detected_count": d["detected_count"], "labels_available": prep.labels}
        if prep.labels:
            res.update({"labeled_anomaly_count": d["labeled_anomaly_count"], "precision": d["precision"],
                        "recall": d["recall"], "macro_f1": d["macro_f1"],
                        "confusion_matrix": [[d["tn"], d["fp"]], [d["fn"], d["tp"]]]})
        results[d["method"]] = res
    doc = {
        "model": cfg.model, "forecast_horizon": cfg.forecast_horizon, "split_method": cfg.split_method,
        "test_size": cfg.test_size, "random_state": cfg.random_state,
        "row_counts": prep.counts, "methods": {m: results[m] for m in cfg.methods},
    }
    return _write(panel, doc, metrics_dir, result_key("comparison", cfg.forecast_horizon))


def run_anomaly_tuning(panel: DataFrame, cfg: AnomalyConfig | None = None, metrics_dir: str | None = None) -> dict[str, Any]:
    """Choose thresholds / contamination on validation, report on test."""

    cfg = cfg or AnomalyConfig()
    if cfg.strict_single_zone:
        check_single_zone(panel, what="Anomaly tuning")
    prep = _prepare(panel, cfg, three_way=True)
    frame = prep.frame
    train = frame.where(F.col("split") == "train")
    val = frame.where(F.col("split") == "validation")
    test = frame.where(F.col("split") == "test")
    labels = prep.labels
    validation_results, selected, test_results = {}, {}, {}
    for method in cfg.methods:
        if method in ("residual_zscore", "robust_residual"):
            grid = list(ZSCORE_GRID if method == "residual_zscore" else ROBUST_GRID)
            det = _residual_detector(method, 0.0).fit_residuals(train, "residual")
            cands = grid_confusion(det.score_residuals(val, "residual"), grid, "anomaly_score", "ge", labels)
            validation_results[method] = [{**payload(c, labels), "config": {"threshold": grid[c["grid_idx"]]}} for c in cands]
            thr = grid[select_best(cands, labels)] if labels else DEFAULT_THRESHOLDS[method]
            det.threshold = thr
            selected[method] = {"threshold": thr, "label_based_selection": labels}
            final = grid_confusion(det.score_residuals(test, "residual"), [thr], "anomaly_score", "ge", labels)[0]
        else:
            grid = list(CONTAMINATION_GRID)
            forest = fit_isolation_forest(train, prep.features, random_state=cfg.random_state, rows=prep.counts["train"])
            offsets = offsets_for(forest.score_samples_frame(train.select(*prep.features)), grid)
            ss_val = forest.score_samples_frame(val, "score_samples")
            cands = grid_confusion(ss_val, offsets, "score_samples", "lt", labels)
            validation_results[method] = [{**payload(c, labels), "config": {"contamination": grid[c["grid_idx"]]}} for c in cands]
            best = select_best(cands, labels)
            selected[method] = {"contamination": grid[best], "label_based_selection": labels}
            ss_test = forest.score_samples_frame(test, "score_samples")
            final = grid_confusion(ss_test, [offsets[best]], "score_samples", "lt", labels)[0]
        test_results[method] = payload(final, labels)
    doc = {
        "configuration": {
            "forecast_horizon": cfg.forecast_horizon, "model": cfg.model, "split_method": cfg.split_method,
            "validation_size": cfg.validation_size, "test_size": cfg.test_size,
            "methods": list(cfg.methods), "random_state": cfg.random_state,
        },
        "row_counts": prep.counts,
        "labels_available": labels,
        "selection_metric": "macro_f1" if labels else "default_configuration",
        "validation_results": validation_results,
        "selected_config_by_method": selected,
        "test_results_by_method": test_results,
    }
    return _write(panel, doc, metrics_dir, result_key("tuning", cfg.forecast_horizon))


def result_key(kind: str, horizon: int, model: str = "ridge") -> str:
    return {
        "comparison": f"anomaly_comparison_h{horizon}",
        "tuning": f"anomaly_tuning_h{horizon}",
        "backtest": f"backtest_{model}_h{horizon}",
        "forecast": f"forecast_{model}_h{horizon}",
    }[kind]


def residual_tuning_frame(
    frame: DataFrame,
    *,
    labels: bool,
    methods: tuple[str, ...] = ("residual_zscore", "robust_residual"),
) -> DataFrame:
    """E4 + E6 + O5 as one lazy plan over a split frame (``split``, ``residual``[, ``actual_anomaly``]).

    Detectors are fitted once on train; validation rows are counted by method,
    place in the method's grid and label, and only these few counts meet the
    grid; the first maximum of macro F1 per method is picked with a window over
    the candidates; test rows are scored with it.
    Returns method, threshold, detected_count and, with labels, the
    confusion counts and precision / recall / macro F1 on test.
    """

    spark = frame.sparkSession
    train = frame.where(F.col("split") == "train")
    val = frame.where(F.col("split") == "validation")
    test = frame.where(F.col("split") == "test")
    label_cols = [LABEL] if labels else []
    val_parts, test_parts, grid_rows = [], [], []
    for method in methods:
        d = _residual_detector(method, 0.0).fit_residuals(train, "residual")
        grid = ZSCORE_GRID if method == "residual_zscore" else ROBUST_GRID
        val_parts.append(d.score_residuals(val, "residual").select(
            F.lit(method).alias("method"), grid_place(F.col("anomaly_score"), grid).alias("_place"), *label_cols))
        test_parts.append(d.score_residuals(test, "residual").select(F.lit(method).alias("method"), "anomaly_score", *label_cols))
        grid_rows += [(method, i, float(t), rank) for i, (t, rank) in enumerate(zip(grid, grid_ranks(grid), strict=True))]
    val_all, test_all = val_parts[0], test_parts[0]
    for v, t in zip(val_parts[1:], test_parts[1:]):
        val_all, test_all = val_all.unionByName(v), test_all.unionByName(t)
    if labels:
        grid = F.broadcast(spark.createDataFrame(grid_rows, "method STRING, grid_idx INT, threshold DOUBLE, rank INT"))
        counts = val_all.groupBy("method", "_place", LABEL).agg(F.count(F.lit(1)).alias("_rows"))  # at most 36 rows
        flagged = counts.join(grid, "method").withColumn("_flag", F.col("_place") > F.col("rank"))
        actual = F.coalesce(F.col(LABEL), F.lit(False))
        cells = {"tn": ~actual & ~F.col("_flag"), "fp": ~actual & F.col("_flag"), "fn": actual & ~F.col("_flag"), "tp": actual & F.col("_flag")}
        cands = flagged.groupBy("method", "grid_idx", "threshold").agg(*[
            F.coalesce(F.sum(F.when(cell, F.col("_rows"))), F.lit(0)).alias(name) for name, cell in cells.items()])
        cands = cands.select("*", *classification_from_counts(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))
        rank = F.row_number().over(Window.partitionBy("method").orderBy(F.col("macro_f1").desc(), F.col("grid_idx")))
        best = cands.withColumn("_rank", rank).where(F.col("_rank") == 1).select("method", "threshold")
    else:
        best = spark.createDataFrame([(m, float(DEFAULT_THRESHOLDS[m])) for m in methods], "method STRING, threshold DOUBLE")
    scored = test_all.join(F.broadcast(best), "method").withColumn("_flag", flagged_at(F.col("anomaly_score"), F.col("threshold")))
    aggs = [F.count_if("_flag").alias("detected_count")]
    if labels:
        aggs += confusion_columns(F.col(LABEL), F.col("_flag"))
    out = scored.groupBy("method", "threshold").agg(*aggs)
    if labels:
        out = out.select("*", *classification_from_counts(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))
    return out
