"""C11-C14: timestamp text, JSON-safe numbers, feature-map predicates and conversions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_timestamp(ts: str | Column) -> Column:
    """C11: ISO text like ``datetime.isoformat``; fractions only when non-zero."""

    t = F.col(ts) if isinstance(ts, str) else ts
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(F.unix_micros(t.cast("timestamp")) % 1_000_000 == 0, whole).otherwise(frac)


def finite_or_null(c: str | Column) -> Column:
    """C12 for one column: NaN and +-inf become NULL (apply before ``to_json``)."""

    x = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None).cast("double")).otherwise(x)


def to_json_safe(*cols: Column) -> Column:
    """``to_json(struct(...))`` that keeps null fields instead of dropping them."""

    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def json_safe(value: Any) -> Any:
    """C12 on driver-side metric documents (bounded size)."""

    if isinstance(value, dict):
        return {str(k): json_safe(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [json_safe(v) for v in value]
    if hasattr(value, "item") and not isinstance(value, (str, bytes)):
        try:
            value = value.item()
        except (AttributeError, ValueError):
            pass
    if isinstance(value, float) and not math.isfinite(value):
        return None
    return value


def all_values_finite(m: str | Column) -> Column:
    """Every map value is a finite number."""

    mp = F.col(m) if isinstance(m, str) else m
    return F.forall(
        F.map_values(mp), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    )


def all_names_nonblank(m: str | Column) -> Column:
    """Every map key is non-blank after trimming."""

    mp = F.col(m) if isinstance(m, str) else m
    return F.forall(F.map_keys(mp), lambda k: k.rlike(r"[^\s\p{Z}\x1c-\x1f\x85]"))


def features_to_map(names: Sequence[str]) -> Column:
    """C14: feature columns to ``map<string,double>``."""

    return F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]), F.array(*[F.col(n).cast("double") for n in names])
    )


def map_to_features(m: str | Column, names: Sequence[str]) -> list[Column]:
    """C14: ``map<string,double>`` back to one column per feature (NULL when absent)."""

    mp = F.col(m) if isinstance(m, str) else m
    return [F.try_element_at(mp, F.lit(n)).alias(n) for n in names]
