"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattlane.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for ``name`` in the shared folder that ``spark.checkpoint.dir`` names."""

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/wattlane-{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and lets every later reader
    prune columns.
    """

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def placed(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows in the order of ``group`` and ``order`` over many tasks, and what turns their place into a place in the group.

    The rows come back with ``piece`` (their range partition) and ``at`` (their
    place in it); the pieces have one row per group and partition it touches:
    piece, the group's columns, ``n`` and ``shift``. A row's 0-based place in its
    group is ``at + shift`` after a join on (piece, group), whose keys hold no
    more rows than a partition does, however large a group is. Ascending, nulls
    first; rows equal in all these columns stand in any order.
    """

    tied = df.withColumn("tie", F.rand(7))  # splits rows that are equal otherwise
    keys = [*group, *order, "tie"]
    ids = tied.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    rows = ids.withColumn("piece", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND(F.lit((1 << 33) - 1)))
    rows = stage(rows.drop("tie"), "placed")
    pieces = rows.groupBy("piece", *group).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy(*group).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")
    return rows, pieces.select("piece", *group, "n", shift.alias("shift"))
