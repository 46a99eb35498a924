"""G1: labelled anomaly injection onto any panel, deterministic and independent of the rows' order.

Re-aim of the reference's sequential injector as a Spark job:

* every row's key is a digest of the seed, its zone and its timestamp; the
  ``max(1, round(n * fraction))`` smallest keys are the anchors, found by exact
  selection (``selection.keys_at``), so that no row is sorted or numbered;
* further digits of the key give the anchor's kind and magnitude: spike
  x U(1.35, 1.8), drop x U(0.45, 0.7), level shift +-U(90, 160) over the anchor and
  the next ``span - 1`` rows of its zone;
* a row sees the events of the rows just before it through lags, which spread a
  hot zone over blocks, and applies all that reach it one after the other in the
  order of their keys, as the reference does in draw order: overlapping events
  compose, and the last one names the row's type;
* every load is then floored and rounded to 3 decimals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.operators.features import FeatureConfig, add_lag_features
from wattlane.operators.ordering import row_number
from wattlane.operators.selection import keys_at
from wattlane.schema import TIMESTAMP, ZONE

# fixed values
KINDS = ("spike", "drop", "level_shift")
# (low, width) of the uniform draws: spike x U(1.35, 1.8), drop x U(0.45, 0.7), shift U(90, 160)
SPIKE_RANGE = (1.35, 0.45)
DROP_RANGE = (0.45, 0.25)
SHIFT_RANGE = (90.0, 70.0)
SHIFT_ROWS = 6


def event_key(seed: int, zone: Column | None) -> Column:
    """32 hex digits of a row, from the seed, its zone and its microseconds of wall-clock time."""

    micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{TIMESTAMP}`)").cast("string")
    parts = [F.lit(f"{seed}"), *([zone.cast("string")] if zone is not None else []), micros]
    return F.md5(F.concat_ws(":", *[F.coalesce(p, F.lit("")) for p in parts]))


def _digits(key: Column, first: int) -> Column:
    """Eight hex digits as a number; the first eight decide the order and are used for nothing else."""

    return F.conv(F.substring(key, first, 8), 16, 10).cast("long")


def _event(key: Column) -> Column:
    """(key, mult, shift, kind) of an anchor."""

    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (_digits(key, 9) % 3 + 1).cast("int"))
    u = _digits(key, 17) / F.lit(float(1 << 32))
    mult = F.when(kind == "spike", F.lit(SPIKE_RANGE[0]) + F.lit(SPIKE_RANGE[1]) * u).when(
        kind == "drop", F.lit(DROP_RANGE[0]) + F.lit(DROP_RANGE[1]) * u).otherwise(1.0)
    sign = F.when(_digits(key, 25) % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    shift = F.when(kind == "level_shift", sign * (F.lit(SHIFT_RANGE[0]) + F.lit(SHIFT_RANGE[1]) * u)).otherwise(0.0)
    return F.struct(key.alias("key"), mult.alias("mult"), shift.alias("shift"), kind.alias("kind"))


def inject_anomalies(
    df: DataFrame,
    fraction: float = 0.02,
    *,
    seed: int = 42,
    floor: float | None = 100.0,
    span: int = SHIFT_ROWS,
    rows: int | None = None,
    load_col: str = "load_mw",
) -> DataFrame:
    """``df`` with its load changed by the events, ``is_anomaly`` and ``anomaly_type`` (normal, spike, drop, level_shift)."""

    if not 0.0 <= fraction < 1.0:
        raise ValueError("anomaly_fraction must be greater than or equal to 0 and less than 1.")
    if span < 1:
        raise ValueError("span must be positive.")
    n = rows if rows is not None else df.count()
    count = min(max(1, int(round(n * fraction))), n)
    zoned = ZONE in df.columns
    order = ["_key", TIMESTAMP, *([ZONE] if zoned else [])]
    keyed = df.withColumn("_key", event_key(seed, F.col(ZONE) if zoned else None))
    if count >= n:
        marked = keyed.withColumn("_anchor", F.lit(True))
    elif (cut := keys_at(keyed, order, [count], n)) is not None:
        marked = keyed.crossJoin(F.broadcast(cut)).withColumn("_anchor", F.struct(*order) < F.col("cut0")).drop("cut0")  # one row
    else:  # rows that share zone and timestamp around the cut
        marked = row_number(keyed, order, name="_rank").withColumn("_anchor", F.col("_rank") < count).drop("_rank")
    events = marked.withColumn("_event", F.when(F.col("_anchor"), _event(F.col("_key")))).drop("_anchor", "_key")
    reach = range(1, span)
    if reach:
        events = add_lag_features(events, FeatureConfig(load_column="_event", lag_periods=tuple(reach)))
    near = [F.when(F.col(f"lag_{i}.kind") == "level_shift", F.col(f"lag_{i}")) for i in reach]
    here = events.withColumn("_events", F.array_sort(F.filter(F.array("_event", *near), lambda e: e.isNotNull())))
    value = F.aggregate("_events", F.col(load_col).cast("double"), lambda v, e: v * e["mult"] + e["shift"])
    if floor is not None:
        value = F.greatest(value, F.lit(float(floor)))
    cols = [
        F.round(value, 3).alias(load_col) if c == load_col else F.col(c)
        for c in df.columns if c not in ("is_anomaly", "anomaly_type")
    ]
    last = F.get("_events", F.size("_events") - 1)["kind"]
    return here.select(*cols, (F.size("_events") > 0).alias("is_anomaly"), F.coalesce(last, F.lit("normal")).alias("anomaly_type"))
