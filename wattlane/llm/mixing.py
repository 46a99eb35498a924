"""Mixing sources to target weights by weighted fair queueing.

Only DataFrame functions. Every document enters the queue twice, so it can be
taken twice. Within a source, documents stand in a fixed shuffled order; an
entry's virtual finish time is the source's cumulative words divided by its
target. All entries are then served in the order of their finish times until
the budget is used up.

No source is summed in one task: documents are dealt into buckets of the
shuffled order, bucket totals give each bucket's offset, and only the running
sum inside a bucket needs a window. The point where the budget ends is found
the same way, from a histogram of finish times.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlane.llm.common import stage

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixConfig:
    """``weights`` repeat over the sources in code point order, null last."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5
    repeats: int = 2
    seed: str = "mix"
    bucket_rows: int = 50_000


def source_targets(sizes: DataFrame, cfg: MixConfig) -> DataFrame:
    """source, rank, n_docs, source_size, target: one row per source.

    The targets are ``min(repeats * source_size, level * weight)`` with the level at
    which they add up to the budget: the highest level that any number of
    capped sources, taken in the order of cap / weight, asks for.
    """

    sources = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("size").cast("long").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, cfg.weights)), (F.col("rank") % len(cfg.weights) + 1).cast("int"))
    sources = sources.withColumn("rank", rank).withColumns(
        {"weight": weight.cast("double"), "cap": F.col("source_size") * float(cfg.repeats)})
    before = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) * cfg.share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    sources = sources.withColumn("asked", left / weights_left)
    sources = sources.withColumn("level", F.max("asked").over(whole))
    return sources.select("source", "rank", "n_docs", "source_size",
                          F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def _cut(queue: DataFrame, n: int, budget: float, cfg: MixConfig) -> tuple[float, int] | None:
    """(finish time, source rank) of the last entry served within the budget; None if not even the first fits."""

    entries = queue.where("size > 0").select(
        "rank", "size", F.explode(F.array(*[
            (F.col("served") + e * F.col("source_size")) / F.col("target") for e in range(cfg.repeats)])).alias("finish"))
    slots = max(64, math.isqrt(n))
    entries = entries.withColumn("slot", F.floor(F.least(F.col("finish"), F.lit(1e6)) * slots))
    totals = entries.groupBy("slot").agg(F.sum("size").alias("total"))
    running = F.sum("total").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0))
    over = totals.withColumn("upto", running).where(F.col("upto") > budget)
    first_over = over.agg(F.min(F.struct("slot", (F.col("upto") - F.col("total")).alias("base"))).alias("f")).first()["f"]
    if first_over is None:
        return math.inf, 0
    inside = entries.where(F.col("slot") == first_over["slot"])
    order = Window.orderBy("finish", "rank").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("upto", F.sum("size").over(order) + first_over["base"]).where(F.col("upto") <= budget)
    last = inside.agg(F.max(F.struct("finish", "rank")).alias("m")).first()["m"]
    if last is None:
        last = entries.where(F.col("slot") < first_over["slot"]).agg(F.max(F.struct("finish", "rank")).alias("m")).first()["m"]
    return (last["finish"], last["rank"]) if last else None


def mix_sources(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
                cfg: MixConfig | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per row of ``docs``.

    Null texts have size 0 and are never taken; a null source is a source of
    its own, ranked last. Rows that repeat a doc_id are documents of their
    own; rows equal in doc_id, source and size are interchangeable. An empty
    table gives an empty result.
    """

    cfg = cfg or MixConfig()
    h = F.md5(F.concat(F.lit(cfg.seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sizes = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    sizes = stage(sizes.withColumn("h", h), "sizes")
    sources = stage(source_targets(sizes, cfg), "sources")
    n, words = sources.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("source_size"), F.lit(0))).first()
    n, budget = int(n), float(words) * cfg.share

    buckets = 1 << min(24, max(4, math.ceil(n / cfg.bucket_rows).bit_length()))
    place = F.conv(F.substring("h", 1, 6), 16, 10).cast("long")
    named = sizes.join(sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
    rows = named.select("doc_id", "rank", "size", "source_size", "target", "h",
                        F.shiftright(place * buckets, 24).alias("bucket"))
    totals = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("total"))
    earlier = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("rank", "bucket", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("rank", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    queue = rows.withColumn("within", F.sum("size").over(inside)).join(offsets, ["rank", "bucket"]).select(
        "doc_id", "rank", "size", "source_size", "target", (F.col("offset") + F.col("within")).alias("served"))
    queue = stage(queue, "queue")

    cut = _cut(queue, n, budget, cfg) if budget else None
    taken = F.lit(0)
    if cut:
        for e in range(cfg.repeats):
            finish = (F.col("served") + e * F.col("source_size")) / F.col("target")
            served = (finish < cut[0]) | ((finish == cut[0]) & (F.col("rank") <= cut[1]))
            taken = taken + F.when((F.col("size") > 0) & served, F.col("size")).otherwise(0)
    return queue.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))
