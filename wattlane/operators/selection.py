"""Exact order statistics of composite keys: the key at a rank, without sorting the table.

A hash sample of the keys inside a bracket gives a narrower bracket around the
rank; one aggregate counts the rows below and inside it, which proves it or
rejects it. The bracket shrinks to about a fiftieth a round, until its keys are
few enough to be sorted in one task. Only the key columns are read; nothing is
exchanged but samples, counts and at most ``candidates`` keys.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

CANDIDATES = 1 << 17
SAMPLE = 1 << 15


@dataclass
class _Bracket:
    """Rows with low <= key <= high (None: open), ``below`` of which stand before them."""

    rank: int
    inside: int
    below: int = 0
    low: Row | None = None
    high: Row | None = None
    seed: int = 0
    tries: int = 0


def _with_rows(df: DataFrame, key: StructType, rows: dict[str, Row | None]) -> DataFrame:
    """``df`` with a constant struct column for each of ``rows``: a broadcast of one row."""

    schema = StructType([StructField(n, key) for n in rows])
    return df.crossJoin(F.broadcast(df.sparkSession.createDataFrame([tuple(rows.values())], schema)))


def _within(b: _Bracket) -> Column:
    low = F.lit(True) if b.low is None else F.col("k") >= F.col("low")
    return low if b.high is None else low & (F.col("k") <= F.col("high"))


def _narrowed(keys: DataFrame, key: StructType, b: _Bracket, sample: int) -> bool:
    """Narrow the bracket in place; False when it can't be, because a few keys fill it."""

    inside = _with_rows(keys, key, {"low": b.low, "high": b.high}).where(_within(b))
    share = min(1.0, sample / b.inside)
    drawn = F.pmod(F.xxhash64("k", F.monotonically_increasing_id(), F.lit(b.seed)), F.lit(1 << 30)) < int(share * (1 << 30))
    row = inside.where(drawn).agg(F.sort_array(F.collect_list("k")).alias("a")).first()  # about ``sample`` keys
    m = len(row["a"])
    at, spread = (b.rank - b.below) / b.inside * m, 3 * math.sqrt(m) + 2
    low = row["a"][int(at - spread)] if at - spread >= 0 else b.low
    high = row["a"][int(at + spread)] if at + spread < m else b.high
    counted = _with_rows(keys, key, {"low": low, "high": high})
    under = F.count_if(F.col("k") < F.col("low")) if low is not None else F.lit(0)
    upto = F.count_if(F.col("k") <= F.col("high")) if high is not None else F.count(F.lit(1))
    below, last = counted.agg(under.alias("u"), upto.alias("v")).first()
    b.seed += 1
    if below <= b.rank < last and last - below < 0.9 * b.inside:
        b.low, b.high, b.below, b.inside, b.tries = low, high, below, last - below, 0
    else:  # the sample missed, or rows equal in the key keep the bracket wide: draw another
        b.tries += 1
    return b.tries < 3


def keys_at(df: DataFrame, order: Sequence[str], ranks: Sequence[int], rows: int, *,
            candidates: int = CANDIDATES, sample: int = SAMPLE) -> DataFrame | None:
    """One row of structs ``cut0``, ``cut1``...: the keys at the 0-based ``ranks`` in ascending order, nulls first.

    So many rows of ``df`` as the rank says are below each key. None when that
    is not so, because rows around a rank are equal in the whole key, or when
    a few keys hold so many rows that no sample narrows a bracket.
    """

    keys = df.select(F.struct(*[F.col(c) for c in order]).alias("k"))
    key = keys.schema["k"].dataType
    found: dict[str, Row] = {}
    place = Window.orderBy("k")
    for i, rank in enumerate(ranks):
        b = _Bracket(rank, rows)
        while b.inside > max(candidates, sample):
            if not _narrowed(keys, key, b, sample):
                return None
        few = _with_rows(keys, key, {"low": b.low, "high": b.high}).where(_within(b)).select("k")  # ``candidates`` at most
        few = few.select("k", F.row_number().over(place).alias("i"), F.lag("k").over(place).alias("before"))
        row = few.where(F.col("i") == rank - b.below + 1).first()
        if row is None or row["before"] == row["k"]:
            return None
        found[f"cut{i}"] = row["k"]
    schema = StructType([StructField(n, key) for n in found])
    return df.sparkSession.createDataFrame([tuple(found.values())], schema)
