"""Importance resampling towards a target distribution.

Every feature (run of words) falls in one of a fixed number of buckets. A
bucket's gain is the log ratio of its shares in the target and in all
documents; the gains are one array, and a document's weight is the mean gain
of its features. Gumbel noise from a hash of the id makes the highest scores a
draw without replacement in proportion to the weights; exact ranks by regular
sampling (see ``regular_sort``) say which are the highest.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import stage
from wattlane.llm.regular_sort import SortConfig, regular_ranks


@dataclass(frozen=True)
class ResampleConfig:
    """``longest``: words of the longest feature. ``share``: percent of the documents with ``least_words`` words that are drawn."""

    longest: int = 1
    buckets: int = 10_000
    seed: str = "2024"
    least_words: int = 20
    share: int = 10


#: A-Z in lower case; what no word holds becomes a space (bytes from 0x80 on belong to words)
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def feature_buckets(text: bytes | None, cfg: ResampleConfig) -> tuple[int, np.ndarray]:
    """Number of words of a UTF-8 text, and the bucket of each of its features."""

    words = text.translate(_FOLD).split(b" ") if text else []
    words = [w for w in words if w]
    crc = list(map(zlib.crc32, words))
    for k in range(2, cfg.longest + 1):
        crc += [zlib.crc32(b" ".join(words[i : i + k])) for i in range(len(words) - k + 1)]
    return len(words), np.array(crc, np.int64) % cfg.buckets


def bucket_counts(docs: DataFrame, text: str, cfg: ResampleConfig) -> np.ndarray:
    """How many features of all texts fall in each bucket; the result has ``buckets`` numbers, whatever the table's size."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cfg.buckets, np.int64)
        for batch in batches:
            for t in batch.column(0):
                total += np.bincount(feature_buckets(t.as_py(), cfg)[1], minlength=cfg.buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    rows = docs.select(F.col(text).cast("binary")).mapInArrow(counted, "bucket long, n long")
    out = np.zeros(cfg.buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(smoothed share in the target / smoothed share in the source)) of every bucket."""

    many, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * (all_source + many) / ((s + 1.0) * (all_target + many))))
        for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: Column, seed: str) -> Column:
    """floor(1000 * Gumbel noise) from a hash of the id; a null id counts as the empty string."""

    named = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def importance_scores(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      target_text: str = "text", carry: Sequence[str] | None = None,
                      cfg: ResampleConfig | None = None) -> DataFrame:
    """``row`` (the columns ``carry``, all by default), n_words, n_features, weight, score; one row per row of ``docs``.

    Whole texts count; null and empty ones have no features and weight 0. An
    empty target makes every gain that of an empty one, which is no error.
    """

    cfg = cfg or ResampleConfig()
    gains = bucket_gains(bucket_counts(docs, text, cfg), bucket_counts(target, target_text, cfg))

    @F.arrow_udf("struct<n_words:long,n_features:long,weight:long>")
    def weighed(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            words, buckets = feature_buckets(t.as_py(), cfg)
            rows.append((words, len(buckets), int(gains[buckets].sum()) // len(buckets) if len(buckets) else 0))
        return pa.StructArray.from_arrays(
            [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], names=["n_words", "n_features", "weight"])

    kept = F.struct(*[F.col(c) for c in (carry or docs.columns)])
    found = docs.select(kept.alias("row"), F.col(doc_id).alias("id"), weighed(F.col(text).cast("binary")).alias("w"))
    return found.select("row", "w.*", (F.col("w.weight") + noise(F.col("id"), cfg.seed)).alias("score"), "id")


def importance_resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
                        target_text: str = "text", carry: Sequence[str] | None = None,
                        cfg: ResampleConfig | None = None, sort: SortConfig | None = None) -> DataFrame:
    """``importance_scores`` with ``rank``: 1, 2, 3... of the drawn documents, null of the others.

    Of the documents with ``least_words`` words, ``share`` percent (rounded down)
    are drawn: the highest scores, ties to the smaller id, then to fewer features;
    a null id comes first. Repeated rows are documents of their own. An empty
    table gives an empty result.
    """

    cfg = cfg or ResampleConfig()
    scored = stage(importance_scores(docs, target, doc_id, text, target_text, carry, cfg), "scored")
    scored = scored.withColumn("low", -F.col("score"))
    able = scored.where(F.col("n_words") >= cfg.least_words)
    drawn = cfg.share * able.count() // 100
    ranked = regular_ranks(able, ["low", "id", "n_features"], sort)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    others = scored.where(F.col("n_words") < cfg.least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).drop("low", "id")


def draw(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
         cfg: ResampleConfig | None = None) -> DataFrame:
    """The drawn documents, with all their columns and no others."""

    return importance_resample(docs, target, doc_id, text, cfg=cfg).where("rank IS NOT NULL").select("row.*")
