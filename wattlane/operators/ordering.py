"""Ordering operators: distributed row numbers, chronological order, tails.

``row_number`` never funnels rows into one task.  It range-partitions the
rows on the ordering key, numbers rows inside each sorted partition with
``monotonically_increasing_id`` (partition id in the high bits, position in
the low 33 bits) and adds each partition's offset, taken from a table with
one row per partition.  That table's size is bounded by the partition count,
so broadcasting it is always safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlane.schema import TIMESTAMP, ZONE

_LOW_BITS = (1 << 33) - 1
_PERSISTED: list[DataFrame] = []


def release_all() -> None:
    """Unpersist every intermediate cached by ``row_number`` in this process.

    Call it only when no DataFrame built on those row numbers will be
    evaluated again: the cache is what keeps both branches of a numbering on
    one range exchange (eviction and executor loss are safe, an explicit
    unpersist of a still-used numbering is not).
    """

    while _PERSISTED:
        _PERSISTED.pop().unpersist()


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_number(
    df: DataFrame,
    order_by: Sequence[str | Column],
    *,
    name: str = "rn",
    partition_by: Sequence[str] = (),
    num_partitions: int | None = None,
    materialize: str = "checkpoint",
) -> DataFrame:
    """Append a 0-based row number ordered by ``order_by`` (optionally per group).

    The ordering key must be unique (per group) for the numbering to be
    deterministic; ties are numbered in an arbitrary but consistent order.
    Work is spread over ``num_partitions`` range partitions, so one hot group
    is split across many tasks instead of landing in one.

    The partition sizes and the rows must come from the *same* range exchange,
    whose bounds are sampled per execution. So the range-partitioned, sorted
    rows are written to the shared checkpoint folder, where neither lost
    executors nor dropped caches change them. ``materialize="persist"`` keeps
    them in executor memory and disks instead: quicker, but the numbering then
    holds only as long as nobody clears the cache; ``release_all()`` frees them.
    """

    keys = [_as_col(c) for c in (*partition_by, *order_by)]
    # without an explicit count, AQE sizes (coalesces) the range partitions from the data;
    # coalescing keeps partitions contiguous, so per-partition numbering stays valid
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = ranged.sortWithinPartitions(*keys)
    tagged = ranged.withColumn("_wl_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_wl_pid", F.shiftright("_wl_mid", 33)).withColumn(
        "_wl_li", F.col("_wl_mid").bitwiseAND(F.lit(_LOW_BITS))
    )
    if materialize == "checkpoint":
        from wattlane.session import cut_lineage

        tagged = cut_lineage(tagged)
    else:
        tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
        _PERSISTED.append(tagged)
    # one row per non-empty partition: safe to broadcast
    sizes = tagged.groupBy("_wl_pid").agg(F.count(F.lit(1)).alias("_wl_cnt"))
    offsets = sizes.select(
        "_wl_pid",
        (F.sum("_wl_cnt").over(Window.orderBy("_wl_pid")) - F.col("_wl_cnt")).alias("_wl_off"),
    )
    numbered = tagged.join(F.broadcast(offsets), "_wl_pid").withColumn(
        name, F.col("_wl_off") + F.col("_wl_li")
    )
    numbered = numbered.drop("_wl_mid", "_wl_pid", "_wl_li", "_wl_off")
    if not partition_by:
        return numbered
    # per-group numbering: subtract each group's first global position.
    # The group table has one row per group; AQE picks broadcast or shuffle by its measured size.
    starts = numbered.groupBy(*partition_by).agg(F.min(name).alias("_wl_start"))
    return (
        numbered.join(starts, list(partition_by))
        .withColumn(name, F.col(name) - F.col("_wl_start"))
        .drop("_wl_start")
    )


def chronological_order(df: DataFrame, timestamp_col: str = TIMESTAMP, zone_col: str = ZONE) -> list[str]:
    """Sort key of the chronological splits: timestamp, then zone when present."""

    if timestamp_col not in df.columns:
        raise ValueError(
            f"Missing timestamp column required for chronological split: {timestamp_col}"
        )
    return [timestamp_col, zone_col] if zone_col in df.columns else [timestamp_col]


def chronological_row_number(
    df: DataFrame, *, name: str = "rn", timestamp_col: str = TIMESTAMP, zone_col: str = ZONE
) -> DataFrame:
    """Global position in (timestamp, zone) order, 0-based."""

    return row_number(df, chronological_order(df, timestamp_col, zone_col), name=name)


def sort_chronologically(df: DataFrame, timestamp_col: str = TIMESTAMP, zone_col: str = ZONE) -> DataFrame:
    """O2: output ordering by (timestamp[, zone])."""

    return df.orderBy(*chronological_order(df, timestamp_col, zone_col))


def sort_panel(df: DataFrame, timestamp_col: str = TIMESTAMP, zone_col: str = ZONE) -> DataFrame:
    """O1: output ordering by (zone, timestamp)."""

    keys = [zone_col, timestamp_col] if zone_col in df.columns else [timestamp_col]
    return df.orderBy(*keys)


def tail_rows(df: DataFrame, n: int, timestamp_col: str = TIMESTAMP, zone_col: str = ZONE) -> DataFrame:
    """O3: the last ``n`` rows in (zone, timestamp) order, returned in that order.

    Uses a descending TakeOrdered (bounded by ``n`` per task), not a full sort.
    """

    if n <= 0:
        raise ValueError("records must be positive.")
    keys = [zone_col, timestamp_col] if zone_col in df.columns else [timestamp_col]
    last = df.orderBy(*[F.col(k).desc() for k in keys]).limit(n)
    return last.orderBy(*keys)
