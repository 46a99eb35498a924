"""Tabular sources re-expressed as canonical panels.

The driver tables carry no energy data, so these adapters project them onto
the canonical schema (timestamp, zone, load_mw, temperature_c,
wind_speed_mps, solar_radiation_wm2).  All are lazy scans with projections
that Catalyst prunes and pushes to the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_panel(spark: SparkSession, sf_dir: str, *, single_zone: bool = False) -> DataFrame:
    """AD1 (zone = event_type) or AD5 (single zone 'ALL') from ``events``.

    load = value, temperature = props.k, wind = user_id % 20, solar = event_id % 1000.
    """

    ev = read_table(spark, sf_dir, "events")
    zone = F.lit("ALL") if single_zone else F.col("event_type")
    return ev.select(
        F.col("ts").alias("timestamp"),
        zone.alias("zone"),
        F.col("value").cast("double").alias("load_mw"),
        F.get_json_object("props", "$.k").try_cast("double").alias("temperature_c"),
        (F.col("user_id") % 20).cast("double").alias("wind_speed_mps"),
        (F.col("event_id") % 1000).cast("double").alias("solar_radiation_wm2"),
    )


def event_hours_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AD2: hourly aggregates per event type (has gaps; see ``densify``)."""

    ev = read_table(spark, sf_dir, "events")
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return ev.groupBy(F.col("event_type").alias("zone"), hour.alias("timestamp")).agg(
        F.sum("value").alias("load_mw"),
        F.avg(F.get_json_object("props", "$.k").try_cast("double")).alias("temperature_c"),
        F.count(F.lit(1)).cast("double").alias("wind_speed_mps"),
        F.max("value").alias("solar_radiation_wm2"),
    ).select("timestamp", "zone", "load_mw", "temperature_c", "wind_speed_mps", "solar_radiation_wm2")


def order_days_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AD3: daily order value per priority."""

    o = read_table(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("zone"), F.col("o_orderdate").alias("timestamp")).agg(
        F.sum("o_totalprice").alias("load_mw"),
        F.avg("o_totalprice").alias("temperature_c"),
        F.count(F.lit(1)).cast("double").alias("wind_speed_mps"),
        F.max("o_totalprice").alias("solar_radiation_wm2"),
    ).select("timestamp", "zone", "load_mw", "temperature_c", "wind_speed_mps", "solar_radiation_wm2")


def supplier_days_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AD4: daily shipped value per supplier (many zones)."""

    li = read_table(spark, sf_dir, "lineitem")
    return li.groupBy(
        F.col("l_suppkey").cast("string").alias("zone"), F.col("l_shipdate").alias("timestamp")
    ).agg(
        F.sum("l_extendedprice").alias("load_mw"),
        F.avg("l_discount").alias("temperature_c"),
        F.sum("l_quantity").alias("wind_speed_mps"),
        F.avg("l_tax").alias("solar_radiation_wm2"),
    ).select("timestamp", "zone", "load_mw", "temperature_c", "wind_speed_mps", "solar_radiation_wm2")


def raw_orders_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw order rows as a panel; keys repeat, which exercises duplicate detection."""

    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_orderpriority").alias("zone"),
        F.col("o_totalprice").alias("load_mw"),
        F.col("o_totalprice").alias("temperature_c"),
        F.lit(1.0).alias("wind_speed_mps"),
        F.col("o_totalprice").alias("solar_radiation_wm2"),
    )


def densify(
    panel: DataFrame, step: str = "1 hour", fill_value: float | None = None, chunk_steps: int = 100_000
) -> DataFrame:
    """Insert missing (zone, timestamp) slots on a regular grid (spine + left join).

    The spine runs per zone from its own min to max.  It is generated in two
    steps so a zone with a long span never expands inside one task: chunk
    starts (one per ``chunk_steps`` slots) are spread over tasks, then each
    chunk expands to its slots.  The spine is joined back on (zone, timestamp).
    """

    every = F.expr(f"INTERVAL {step}")
    bounds = panel.groupBy("zone").agg(F.min("timestamp").alias("lo"), F.max("timestamp").alias("hi"))
    chunks = bounds.select(
        "zone", "hi", F.explode(F.sequence("lo", "hi", every * F.lit(chunk_steps))).alias("start")
    ).repartition("zone", "start")
    last = F.least(F.col("start") + every * F.lit(chunk_steps - 1), F.col("hi"))
    spine = chunks.select("zone", F.explode(F.sequence("start", last, every)).alias("timestamp"))
    filled = spine.join(panel, ["zone", "timestamp"], "left")
    if fill_value is not None:
        filled = filled.fillna(fill_value)
    return filled.select(*panel.columns)
