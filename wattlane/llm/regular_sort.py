"""Exact ranks of a whole table by regular sampling (parallel sorting by regular sampling).

The rows are sorted in runs, one a task. Every ``step``-th row of each run is a
sample; every so many-th sample in their common order is a splitter, so that no
segment between splitters holds over twice its fair share of rows, whatever the
keys: a row's place in its run breaks ties, so even equal rows are split. Rows
are exchanged by segment and merged there; the counts of the segments before
give the ranks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlane.llm.common import stage


@dataclass(frozen=True)
class SortConfig:
    """``runs``: how many runs, and about as many segments; by default the root of the rows over 16, at most ``most_runs``.

    There are about runs * runs samples, which one task sorts: 4 million at most.
    """

    runs: int | None = None
    most_runs: int = 2_048


def _below(key: Column, splitters: Column, n: int) -> Column:
    """How many of ``n`` sorted splitters are at most ``key``, by bisection."""

    span = F.struct(F.lit(0).alias("low"), F.lit(n).alias("high"))

    def halved(span: Column, _round: Column) -> Column:
        open_ = span["low"] < span["high"]
        middle = F.shiftright(span["low"] + span["high"], 1)
        right = open_ & (F.get(splitters, middle) <= key)
        return F.struct(F.when(right, middle + 1).otherwise(span["low"]).alias("low"),
                        F.when(open_ & ~right, middle).otherwise(span["high"]).alias("high"))

    rounds = F.array(*[F.lit(i) for i in range(n.bit_length() + 1)])
    return F.aggregate(rounds, span, halved, lambda span: span["low"])


def regular_ranks(df: DataFrame, order: Sequence[str], cfg: SortConfig | None = None, name: str = "rank") -> DataFrame:
    """``df`` with ``name``: 1, 2, 3... in ascending order of the columns ``order``, nulls first.

    ``df`` should be a written table (see ``stage``), as it is read twice. Rows
    equal in all of ``order`` get ranks of their own in any order. An empty
    table gives an empty result.
    """

    cfg = cfg or SortConfig()
    n = df.count()
    parts = cfg.runs or max(1, min(cfg.most_runs, math.ceil(math.sqrt(n) / 16)))
    step = max(1, n // (parts * parts))

    packed = df.coalesce(parts).select(F.struct("*").alias("row"))
    keys = [F.col("row")[c] for c in order]
    runs = packed.sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    runs = stage(runs, "runs")  # the task's number and the place in its run are one number, `at`
    key = F.struct(*keys, "at")
    samples = runs.where(F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) % step == 0).select(key.alias("key"))
    m = samples.count()
    every = max(1, math.ceil(m / parts))
    place = F.row_number().over(Window.orderBy("key"))
    splitters = samples.withColumn("place", place).where(F.col("place") % every == 0).select("key")
    # one row that holds less than `parts` keys: a broadcast with a proven bound
    splitters = splitters.agg(F.sort_array(F.collect_list("key")).alias("splitters"))
    segment = _below(key, F.col("splitters"), m // every).alias("segment")
    segments = stage(runs.crossJoin(F.broadcast(splitters)).select("row", "at", segment), "segments")

    sizes = segments.groupBy("segment").agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("segment", F.coalesce(before, F.lit(0)).alias("start"))  # a row per segment
    merged = F.row_number().over(Window.partitionBy("segment").orderBy(*keys, "at"))
    ranked = segments.withColumn("merged", merged).join(F.broadcast(starts), "segment")
    return ranked.select("row.*", (F.col("start") + F.col("merged")).alias(name))
