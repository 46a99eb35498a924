"""Quality scores of texts by Bradley-Terry pairwise ranking.

A document of the better label is preferred to one of the worse. The odds of a
preference are the exponential of the difference of two scores, which are linear
in features of the text; so a logistic regression without intercept on
differences of features fits them. A quantile of the fitted scores, at the
share of the worse label, is the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlane.llm.common import placed, stage


@dataclass(frozen=True)
class QualityConfig:
    """``pairs``: preference pairs, at least; there are as many as every labelled document needs to be in one. ``at``: the score, from 0 to 1, given to the threshold.
    ``reach``: features count as at most so many deviations from their mean.
    """

    pairs: int = 20_000
    at: float = 0.3
    reach: float = 4.0
    penalty: float = 1e-3
    steps: int = 60
    seed: int = 5


def _classes() -> np.ndarray:
    groups = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r", "\t\v\f", ".,;:!?", "'\"()-"]
    out = np.full(256, len(groups), np.int64)  # other symbols
    for k, chars in enumerate(groups):
        out[list(chars.encode())] = k
    out[128:] = len(groups) + 1
    out[:32][out[:32] == len(groups)] = len(groups) + 2
    return out


_CLASS = _classes()
_N = int(_CLASS.max()) + 1
N_FEATURES = 11 + _N + _N * _N


def features(text: str | None) -> np.ndarray:
    """Shape of a whole text: lengths, repetition, case, and shares of byte classes and of their neighbours."""

    data = (text or "").encode("utf-8", "replace")
    x = np.frombuffer(data, np.uint8)
    kinds, words = _CLASS[x], data.split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    n, m = max(len(x), 1), max(len(words), 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    pairs = np.bincount(kinds[:-1] * _N + kinds[1:], minlength=_N * _N) if len(x) > 1 else np.zeros(_N * _N)
    shape = [
        math.log1p(len(x)), math.log1p(len(words)), sizes.mean(), sizes.std(), len(set(words)) / m, math.log1p(len(lines)),
        math.log1p(len(x) / max(len(lines), 1)), 1 - len(set(lines)) / max(len(lines), 1),
        np.count_nonzero(x[1:] == x[:-1]) / n, sum(map(bytes.isupper, words)) / m, np.count_nonzero(sizes == 1) / m]
    return np.concatenate([shape, np.bincount(kinds, minlength=_N) / n, np.sqrt(pairs / n)])


@dataclass(frozen=True)
class QualityModel:
    """score = weights . clipped standard features; ``cut`` is the threshold; None when there was nothing to compare."""

    cfg: QualityConfig
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    cut: float

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -self.cfg.reach, self.cfg.reach)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.standard(x) @ self.weights

    def score_text(self, text: str | None) -> float:
        """0 to 1; ``at`` at the threshold. Null and empty texts have the features of an empty one."""

        if self.weights is None:
            return self.cfg.at
        odds = math.log(self.cfg.at / (1 - self.cfg.at)) + float(self.raw(features(text))) - self.cut
        return 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0

    def score(self, text: Column | str) -> Column:
        @F.arrow_udf("double")
        def scored(texts: pa.Array) -> pa.Array:
            return pa.array([self.score_text(t.as_py()) for t in texts], pa.float64())

        return scored(text)


def _vectors(texts: DataFrame) -> DataFrame:
    """(id, head, x) of the rows (id, text): the text's first 200 characters, and its features."""

    def shaped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [t.as_py() or "" for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t[:200] for t in found], pa.string()),
                                              pa.array([features(t) for t in found], pa.list_(pa.float64()))], names=["id", "head", "x"])

    return texts.mapInArrow(shaped, f"id {texts.schema['id'].dataType.simpleString()}, head string, x array<double>")


def _matrix(x: pa.Array) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), N_FEATURES)


def _gaps(vectors: DataFrame, model: QualityModel, counts: dict[int, int]) -> DataFrame:
    """(features, label) of preference pairs: every document of either label is in one, beside a partner drawn by a hash."""

    cfg = model.cfg
    keyed = vectors.withColumn("h", F.xxhash64("id", F.lit(cfg.seed)))
    rows, pieces = placed(keyed, ["better"], ["h", "id"])
    numbered = rows.join(F.broadcast(pieces), ["piece", "better"]).withColumn("place", F.col("at") + F.col("shift"))  # one piece a task
    k = F.col("k")
    # as k grows, i goes through the preferred documents, and j through the others from a new start each time
    turn = F.pmod(F.xxhash64(F.expr(f"k div {counts[0]}"), F.lit(cfg.seed)), F.lit(counts[0]))
    pairs = vectors.sparkSession.range(max(cfg.pairs, *counts.values())).select(
        F.col("id").alias("k")).select("k", (k % counts[1]).alias("i"), ((k + turn) % counts[0]).alias("j"))
    win = numbered.where("better = 1").select(F.col("place").alias("i"), F.col("x").alias("win"))
    lose = numbered.where("better = 0").select(F.col("place").alias("j"), F.col("x").alias("lose"))

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0).to_numpy() % 2 == 0  # every other pair the other way round, as a regression wants both answers
            gap = model.standard(_matrix(batch.column(1))) - model.standard(_matrix(batch.column(2)))
            gap *= np.where(label, 1.0, -1.0)[:, None]
            yield pa.RecordBatch.from_arrays([pa.array(label.astype(float)), pa.array(list(gap), pa.list_(pa.float64()))], names=["label", "x"])

    gaps = pairs.join(win, "i").join(lose, "j").select("k", "win", "lose").mapInArrow(differ, "label double, x array<double>")
    return stage(gaps, "pairs").select(array_to_vector("x").alias("features"), "label")


def _threshold(vectors: DataFrame, rows: int, model: QualityModel, weight: dict[int, float], share: float) -> float:
    """Where the scores below are the ``share`` of all, a row of a label counting as ``weight`` says; halfway between two scores.

    Equal scores are counted first. The counts are sorted over many tasks, and only the part that the share falls into is added up.
    """

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.raw(_matrix(batch.column(1))))], names=["better", "s"])

    levels = vectors.select("better", "x").mapInArrow(raw, "better int, s double").groupBy("s").agg(
        *[F.count_if(F.col("better") == b).alias(f"n{b}") for b in (0, 1)])
    levels = levels.repartitionByRange(math.ceil(rows / 16_384), "s").sortWithinPartitions("s")
    levels = stage(levels.withColumn("part", F.spark_partition_id()), "levels")
    parts = levels.groupBy("part").agg(F.max("s").alias("s"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).orderBy("part").collect()

    def mass(n0: int, n1: int) -> float:
        return n0 * weight[0] + n1 * weight[1]

    goal = (share + 1e-12) * mass(sum(r["n0"] for r in parts), sum(r["n1"] for r in parts))
    n0 = n1 = 0
    before = None
    for r in parts:
        if mass(n0 + r["n0"], n1 + r["n1"]) > goal:
            break
        n0, n1, before = n0 + r["n0"], n1 + r["n1"], r["s"]
    else:
        return before
    upto, inside = Window.orderBy("s"), levels.where(F.col("part") == r["part"])  # one part
    seen = inside.select("s", "n0", "n1", F.lag("s").over(upto).alias("before"), (F.sum("n0").over(upto) + n0).alias("upto0"),
                         (F.sum("n1").over(upto) + n1).alias("upto1"))
    at = seen.where(F.col("upto0") * weight[0] + F.col("upto1") * weight[1] > goal).orderBy("s").first()
    before = before if at["before"] is None else at["before"]
    first = mass(at["upto0"] - at["n0"], at["upto1"] - at["n1"]) + (weight[0] if at["n0"] else weight[1])
    return (before + at["s"]) / 2 if before is not None and first > goal else at["s"]


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          cfg: QualityConfig | None = None) -> QualityModel:
    """Fit on pairs of documents labelled 1 and 0; the first are preferred.

    Every labelled id is learned from: the moments, the pairs and the threshold
    take all of them, one text each (when an id has several, the least by its
    first 200 characters, then by its features). Labels other than 0 and 1, null ids and ids without a document teach nothing. When a
    label has no document at all, there is nothing to compare and every text
    scores ``at``.
    """

    cfg = cfg or QualityConfig()
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("better")).where(
        F.col("id").isNotNull() & F.col("better").isin(0, 1)).distinct()
    sizes = {r["better"]: r["n"] for r in known.groupBy("better").agg(F.count(F.lit(1)).alias("n")).collect()}
    nothing = QualityModel(cfg, np.zeros(N_FEATURES), np.ones(N_FEATURES), None, 0.0)
    if len(sizes) < 2:
        return nothing
    # the texts stay where they are and only what is learned of them is exchanged, whatever the number of labels
    shapes = _vectors(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("id IS NOT NULL"))
    least = shapes.hint("merge").join(known, "id").groupBy("id", "better").agg(F.min(F.struct("head", "x")).alias("least"))
    vectors = stage(least.select("id", "better", F.col("least.x").alias("x")), "vectors")
    counts = {r["better"]: r["n"] for r in vectors.groupBy("better").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return nothing
    moments = vectors.agg(Summarizer.metrics("mean", "std").summary(array_to_vector("x")).alias("m")).first()["m"]
    model = QualityModel(cfg, moments["mean"].toArray(), moments["std"].toArray() + 1e-6, np.zeros(N_FEATURES), 0.0)
    fit = LogisticRegression(fitIntercept=False, standardization=False, regParam=cfg.penalty, maxIter=cfg.steps).fit(
        _gaps(vectors, model, counts))
    model = replace(model, weights=fit.coefficients.toArray())
    # as large a share of the learned scores lies below the threshold as of the labels is 0; a label's ids without a document
    # are taken to be like those with one
    cut = _threshold(vectors, sum(counts.values()), model, {b: sizes[b] / counts[b] for b in (0, 1)}, sizes[0] / (sizes[0] + sizes[1]))
    return replace(model, cut=cut)


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned: crc32 of the id as text, modulo 5, is 0."""

    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def rate(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
         cfg: QualityConfig | None = None) -> DataFrame:
    """``row`` (all columns of the document), held_out, score, predicted; one row per row of ``docs``.

    Learns from the labels that aren't held out and scores every whole text. A
    null doc_id counts as not held out; repeated rows are scored alike; an empty
    table gives an empty result.
    """

    cfg = cfg or QualityConfig()
    model = train(docs, labels.where(~held_out(F.col(doc_id))), doc_id, text, label, cfg)
    scored = docs.select(F.struct("*").alias("row"), held_out(F.col(doc_id)).alias("held_out"),
                         model.score(F.col(text)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= cfg.at).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, cfg: QualityConfig | None = None) -> DataFrame:
    """The documents, with all their columns, that score at the threshold or above."""

    return rate(docs, labels, cfg=cfg).where("predicted = 1").select("row.*")
