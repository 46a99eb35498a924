"""Isolation forest (Liu, Ting, Zhou 2008) as Spark jobs.

Fit
  1. median imputation values (exact distributed medians of the train rows);
  2. rows are numbered in a fixed order (distributed row number, or the ``rn``
     that chronological splits carry); each tree draws ``psi`` of all positions
     without replacement, by seed; the ``trees * psi`` positions, a proven
     bound, are broadcast and joined to the numbered rows;
  3. ``groupBy(tree).applyInPandas`` grows one tree per group (at most
     ``psi`` rows each), emitting a node table of at most
     ``trees * (2 psi - 1)`` rows -- a proven bound, so it is broadcast.
Score
  ``mapInPandas`` walks all trees for a whole Arrow batch with numpy;
  ``score_samples = -2^(-E[h(x)] / c(psi))``.  The decision offset is -0.5 for
  ``auto``, otherwise the contamination quantile of the train scores (exact
  distributed quantile).  ``is_anomaly`` is ``score_samples < offset``
  (strict) and ``anomaly_score = offset - score_samples``.

Same distribution as the reference's forest, not the same random draws.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from wattlane.functions.missing import known
from wattlane.operators.ordering import row_number
from wattlane.operators.quantiles import column_medians, exact_quantiles

_EULER = 0.5772156649015329
NODE_SCHEMA = "tree INT, node INT, feature INT, threshold DOUBLE, left_child INT, right_child INT, size INT, depth INT"


def average_path_length(n: np.ndarray | float) -> np.ndarray:
    """c(n): expected path length of an unsuccessful BST search among n points."""

    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    two = n == 2
    big = n > 2
    out[two] = 1.0
    nb = n[big]
    out[big] = 2.0 * (np.log(nb - 1.0) + _EULER) - 2.0 * (nb - 1.0) / nb
    return out


def grow_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """One isolation tree as rows (node, feature, threshold, left, right, size, depth)."""

    nodes: list[list] = []
    stack = [(np.arange(len(x)), 0, -1, 0)]
    while stack:
        rows, depth, parent, side = stack.pop()
        idx = len(nodes)
        nodes.append([idx, -1, 0.0, -1, -1, len(rows), depth])
        if parent >= 0:
            nodes[parent][3 if side == 0 else 4] = idx
        if depth >= max_depth or len(rows) <= 1:
            continue
        sub = x[rows]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        candidates = np.flatnonzero(hi > lo)
        if candidates.size == 0:
            continue
        f = int(rng.choice(candidates))
        thr = float(rng.uniform(lo[f], hi[f]))
        if thr >= hi[f]:
            thr = float(lo[f])
        go_left = sub[:, f] <= thr
        nodes[idx][1], nodes[idx][2] = f, thr
        stack.append((rows[~go_left], depth + 1, idx, 1))
        stack.append((rows[go_left], depth + 1, idx, 0))
    return [tuple(n) for n in nodes]


@dataclass
class IsolationForestModel:
    feature_names: list[str]
    medians: dict[str, float | None]
    nodes: pd.DataFrame = field(repr=False)
    psi: int = 256
    trees: int = 100
    contamination: float | str = "auto"
    offset: float = -0.5

    def _arrays(self) -> tuple:
        nd = self.nodes.sort_values(["tree", "node"])
        counts = nd.groupby("tree").size().to_numpy()
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        base = np.repeat(starts, counts)
        left = np.where(nd["left_child"].to_numpy() >= 0, nd["left_child"].to_numpy() + base, -1)
        right = np.where(nd["right_child"].to_numpy() >= 0, nd["right_child"].to_numpy() + base, -1)
        leaf_len = nd["depth"].to_numpy() + average_path_length(nd["size"].to_numpy())
        return (starts, nd["feature"].to_numpy(), nd["threshold"].to_numpy(), left, right, leaf_len)

    def score_samples_frame(self, df: DataFrame, name: str = "score_samples") -> DataFrame:
        """Append ``score_samples`` (higher = more normal) computed batch-wise."""

        missing = [f for f in self.feature_names if f not in df.columns]
        if missing:
            raise ValueError(f"Missing required detector features: {', '.join(missing)}.")
        starts, feat, thr, left, right, leaf_len = self._arrays()
        norm = float(average_path_length(np.array([self.psi]))[0]) or 1.0
        names = list(self.feature_names)
        fill = np.array([self.medians.get(f) if self.medians.get(f) is not None else np.nan for f in names])
        tmp = [f"_wl_if_{i}" for i in range(len(names))]
        staged = df.select("*", *[F.col(f).cast("double").alias(t) for f, t in zip(names, tmp)])
        out_schema = StructType([*staged.schema.fields, StructField(name, DoubleType())])

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                x = pdf[tmp].to_numpy(dtype=float, na_value=np.nan)
                bad = np.isnan(x)
                if bad.any():
                    x = np.where(bad, fill[None, :], x)
                total = np.zeros(len(x))
                rows = np.arange(len(x))
                for s in starts:
                    node = np.full(len(x), s)
                    while True:
                        f = feat[node]
                        inner = f >= 0
                        if not inner.any():
                            break
                        fi = np.where(inner, f, 0)
                        go_left = x[rows, fi] <= thr[node]
                        nxt = np.where(go_left, left[node], right[node])
                        node = np.where(inner, nxt, node)
                    total += leaf_len[node]
                pdf[name] = -np.power(2.0, -(total / len(starts)) / norm)
                yield pdf

        return staged.mapInPandas(score, out_schema).drop(*tmp)

    def score(self, df: DataFrame, offset: float | None = None) -> DataFrame:
        """``anomaly_score`` = offset - score_samples, ``is_anomaly`` = score_samples < offset."""

        off = self.offset if offset is None else offset
        scored = self.score_samples_frame(df, "_wl_ss")
        return scored.withColumn("anomaly_score", F.lit(off) - F.col("_wl_ss")).withColumn(
            "is_anomaly", F.col("_wl_ss") < F.lit(off)
        ).drop("_wl_ss")


def offset_for(train_scores: DataFrame, contamination: float | str, column: str = "score_samples") -> float:
    if contamination == "auto":
        return -0.5
    return offsets_for(train_scores, [contamination], column)[0]


def offsets_for(train_scores: DataFrame, grid: Sequence[float | str], column: str = "score_samples") -> list[float]:
    """Offsets for several contamination values from one exact quantile job."""

    probs = sorted({float(c) for c in grid if c != "auto"})
    found: dict[float, float] = {}
    if probs:
        row = exact_quantiles(train_scores, column, probs, names=[f"p{i}" for i in range(len(probs))]).first()
        found = {p: float(row[f"p{i}"]) for i, p in enumerate(probs)}
    return [-0.5 if c == "auto" else found[float(c)] for c in grid]


def _distinct_positions(rng: np.random.Generator, n: int, k: int) -> np.ndarray:
    """``k`` different positions below ``n``, each set equally likely, in memory of the order of ``k``."""

    if n <= 4 * k:
        return rng.permutation(n)[:k]
    found = np.empty(0, np.int64)
    while len(found) < k:
        drawn = np.concatenate([found, rng.integers(0, n, k)])
        found = drawn[np.sort(np.unique(drawn, return_index=True)[1])]
    return found[:k]


def fit_isolation_forest(
    df: DataFrame,
    feature_names: Sequence[str],
    *,
    contamination: float | str = "auto",
    random_state: int = 42,
    trees: int = 100,
    max_samples: int = 256,
    rows: int | None = None,
) -> IsolationForestModel:
    names = list(feature_names)
    if not names:
        raise ValueError("feature_names must not be empty.")
    if contamination != "auto" and not 0.0 < float(contamination) <= 0.5:
        raise ValueError("contamination must be 'auto' or a value in (0, 0.5].")
    n = rows if rows is not None else df.count()
    if n == 0:
        raise ValueError("features must contain at least one row.")
    psi = min(max_samples, n)
    medians = column_medians(df, names)
    depth = int(math.ceil(math.log2(max(psi, 2))))
    feats = [F.coalesce(known(f), F.lit(medians.get(f))).alias(f"f{i}") for i, f in enumerate(names)]
    first, last = df.agg(F.min("rn"), F.max("rn")).first() if "rn" in df.columns else (0, -1)
    if last - first + 1 == n:  # a part of a split: its positions follow on from the first
        numbered = df.select((F.col("rn") - F.lit(first)).alias("_pos"), *feats)
    else:
        numbered = row_number(df.select(F.xxhash64(*df.columns).alias("_h"), *feats), ["_h", *[f"f{i}" for i in range(len(names))]],
                              name="_pos")
    rng = np.random.default_rng(random_state)
    drawn = [(t, int(i)) for t in range(trees) for i in _distinct_positions(rng, n, psi)]
    sample = numbered.join(F.broadcast(df.sparkSession.createDataFrame(drawn, "tree INT, _pos BIGINT")), "_pos")
    cols = [f"f{i}" for i in range(len(names))]

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([random_state, t])
        rows_ = grow_tree(pdf[cols].to_numpy(dtype=float), rng, depth)
        out = pd.DataFrame(rows_, columns=["node", "feature", "threshold", "left_child", "right_child", "size", "depth"])
        out.insert(0, "tree", t)
        return out

    nodes = sample.select("tree", *cols).groupBy("tree").applyInPandas(build, NODE_SCHEMA).toPandas()
    model = IsolationForestModel(names, medians, nodes, psi=psi, trees=trees, contamination=contamination)
    if contamination != "auto":
        model.offset = offset_for(model.score_samples_frame(df.select(*names)), contamination)
    return model
