"""Exact distributed quantiles with linear interpolation.

Spark's exact ``percentile``/``median`` keep every value of a group in one
aggregation buffer, which does not survive a group holding a third of the
data. Here ``percentile_approx`` (a mergeable sketch, combined map-side)
brackets the two ranks around each position; the next aggregate counts the
values below, at and between the brackets and, once the sketch's own error
bound says that they are few, collects those between. While the bound says
they may be many, the bracket is narrowed by another sketch of the values
inside it. Raw values are never shuffled when there is one group, and the
brackets are literals then; with groups, the brackets are a table of one row
per group, joined as its size allows.

Every bracket is verified by its counts; a group whose ranks lie outside it is
computed again by ranking (``method="sort"``: the distributed ``row_number``).
The results equal numpy's default ``linear`` ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.operators.ordering import row_number
from wattlane.session import cut_lineage

#: values between two brackets that one group's aggregate may collect
CANDIDATES = 1 << 17


def _name(p: float) -> str:
    return "q" + f"{p:.6f}".rstrip("0").rstrip(".").replace(".", "_")


def _lerp(a: Column, b: Column, t: Column) -> Column:
    # numpy's lerp: a + (b-a)*t, evaluated from the upper end when t >= 0.5
    return F.when(t >= 0.5, b - (b - a) * (1 - t)).otherwise(a + (b - a) * t)


def exact_quantiles(
    df: DataFrame,
    value: str | Column,
    probs: Sequence[float],
    *,
    by: Sequence[str] = (),
    names: Sequence[str] | None = None,
    method: str = "refine",
    accuracy: int = 10_000,
    candidates: int = CANDIDATES,
) -> DataFrame:
    """Quantiles of ``value`` per ``by`` group; nulls and NaNs are ignored.

    Returns one row per group with one column per probability (``names`` or
    ``q0_5`` style).  Groups without values produce no row.
    """

    if not probs:
        raise ValueError("at least one probability is required.")
    names = list(names or [_name(p) for p in probs])
    v = F.col(value) if isinstance(value, str) else value
    vals = df.select(*by, v.cast("double").alias("_wl_v")).where(
        F.col("_wl_v").isNotNull() & ~F.isnan("_wl_v")
    )
    if method == "sort":
        return _by_sort(vals, list(probs), list(by), names)
    targets = [("_wl_v", float(p)) for p in probs]
    found = _refine(vals, targets, list(by), accuracy, candidates).where(F.col("n0") > 0)
    out = found.select(*by, "ok", *[F.col(f"q{i}").alias(n) for i, n in enumerate(names)])
    if out.where(~F.col("ok")).isEmpty():
        return out.drop("ok")
    # ranks outside their bracket in some groups: these are computed again by sorting
    missed = out.where(~F.col("ok")).select(*by)
    redo = _by_sort(vals.join(missed, by, "left_semi") if by else vals, list(probs), list(by), names)
    return out.where("ok").drop("ok").unionByName(redo)


def _with_state(vals: DataFrame, state: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Every row with its group's ``columns`` of the state: literals without groups, else an equi-join."""

    if by:
        return vals.join(state.select(*by, *columns), by)
    row = state.first()
    return vals.select("*", *[F.lit(row[c]).cast(state.schema[c].dataType).alias(c) for c in columns])


def _refine(
    vals: DataFrame, targets: list[tuple[str, float]], by: list[str], accuracy: int, candidates: int
) -> DataFrame:
    """Per group: n{i}, q{i} of every target (column, probability), and ``ok`` when all brackets held."""

    margin, k = 3.0 / accuracy, range(len(targets))
    sketch = []
    for i, (c, p) in enumerate(targets):
        sketch += [F.count(c).alias(f"n{i}"),
                   F.percentile_approx(c, [max(0.0, p - margin), min(1.0, p + margin)], accuracy).alias(f"b{i}")]
    state = _small(vals.groupBy(*by).agg(*sketch), by).select(*by, *[f"n{i}" for i in k], *[
        F.get(f"b{i}", F.lit(j)).alias(f"{e}{i}") for i in k for j, e in enumerate(("lo", "hi"))])
    pos = [(F.col(f"n{i}") - 1) * F.lit(p) for i, (_, p) in enumerate(targets)]
    bounds = [f"{e}{i}" for i in k for e in ("lo", "hi")]
    share = 2 * margin + 2.0 / accuracy  # of a group's values that can lie between its brackets
    largest = state.agg(F.max(F.greatest(*[F.col(f"n{i}") for i in k], F.lit(0)))).first()[0] or 0
    between = largest * share
    while between > candidates:
        counted = _small(_with_state(vals, state, by, bounds).groupBy(*by).agg(*_counts(targets)), by)
        inner = (state.join(counted, by) if by else state.crossJoin(counted)).withColumns({
            f"{e}{i}": F.when(F.col(f"in{i}") > 0, (pos[i] - F.col(f"under{i}") - F.col(f"at{i}") + d) / F.col(f"in{i}"))
            for i in k for e, d in (("from", -0.5), ("to", 1.5))})
        inside = _with_state(vals, state, by, bounds).groupBy(*by).agg(*[
            F.percentile_approx(F.when((F.col(c) > F.col(f"lo{i}")) & (F.col(c) < F.col(f"hi{i}")), F.col(c)),
                                [j / 1000 for j in range(1001)], accuracy).alias(f"grid{i}")
            for i, (c, _) in enumerate(targets)])
        inside = _small(inside, by)
        state = _narrowed(inner.join(inside, by) if by else inner.crossJoin(inside), by, k)
        between *= 8.0 / 1000  # grid steps that can lie between the new brackets
    rows = _with_state(vals, state, by, bounds)
    collected = [
        F.sort_array(F.collect_list(
            F.when((F.col(c) > F.col(f"lo{i}")) & (F.col(c) < F.col(f"hi{i}")), F.col(c)))).alias(f"mid{i}")
        for i, (c, _) in enumerate(targets)]
    final = rows.groupBy(*by).agg(*_counts(targets), *collected)
    final = state.join(final, by) if by else state.crossJoin(F.broadcast(final))  # one row each
    out, ok = [], F.lit(True)
    for i in k:
        low, high = _at_rank(F.floor(pos[i]), i), _at_rank(F.ceil(pos[i]), i)
        out.append(_lerp(low, high, pos[i] - F.floor(pos[i])).alias(f"q{i}"))
        ok = ok & ((F.col(f"n{i}") == 0) | (low.isNotNull() & high.isNotNull()))
    return _small(final.select(*by, *[f"n{i}" for i in k], *out, ok.alias("ok")), by)


def _small(table: DataFrame, by: list[str]) -> DataFrame:
    """A table of one row per group, computed once; without groups, its one row goes by the driver."""

    return cut_lineage(table) if by else table.sparkSession.createDataFrame(table.collect(), table.schema)


def _counts(targets: list[tuple[str, float]]) -> list[Column]:
    """By target: values under the lower bracket, at it, strictly between the two."""

    out = []
    for i, (c, _) in enumerate(targets):
        lo, hi, v = F.col(f"lo{i}"), F.col(f"hi{i}"), F.col(c)
        out += [F.count_if(v < lo).alias(f"under{i}"), F.count_if(v == lo).alias(f"at{i}"),
                F.count_if((v > lo) & (v < hi)).alias(f"in{i}"), F.count_if((v == hi) & (hi > lo)).alias(f"top{i}")]
    return out


def _at_rank(rank: Column, i: int) -> Column:
    """The value of a rank, counted from 0; NULL where it lies outside the brackets."""

    first = rank - F.col(f"under{i}")
    inner = first - F.col(f"at{i}")
    return (
        F.when(first < 0, F.lit(None).cast("double"))
        .when(inner < 0, F.col(f"lo{i}"))
        .when(inner < F.col(f"in{i}"), F.get(f"mid{i}", inner.cast("int")))
        .when(inner < F.col(f"in{i}") + F.col(f"top{i}"), F.col(f"hi{i}"))
    )


def _narrowed(state: DataFrame, by: list[str], k: range) -> DataFrame:
    """Brackets moved to the grid points two steps around the ranks; a rank at an old bracket keeps it alone."""

    new = {}
    for i in k:
        lo, hi, grid = F.col(f"lo{i}"), F.col(f"hi{i}"), F.col(f"grid{i}")
        below = F.floor(F.col(f"from{i}") * 1000).cast("int") - 2
        above = F.ceil(F.col(f"to{i}") * 1000).cast("int") + 2
        some = grid.isNotNull() & (F.size(grid) > 0)
        new[f"lo{i}"] = F.when(some & (below > 0), F.coalesce(F.get(grid, F.least(below, F.lit(1000))), lo)).otherwise(lo)
        new[f"hi{i}"] = F.when(some & (above < 1000), F.coalesce(F.get(grid, F.greatest(above, F.lit(0))), hi)).otherwise(hi)
    return state.select(*by, *[f"n{i}" for i in k], *[c.alias(n) for n, c in new.items()])


def _by_sort(vals: DataFrame, probs: list[float], by: list[str], names: list[str]) -> DataFrame:
    numbered = row_number(vals, [*by, "_wl_v"], name="_wl_g")
    stats = numbered.groupBy(*by).agg(
        F.min("_wl_g").alias("_wl_s"), F.count(F.lit(1)).alias("_wl_n")
    )
    if by:
        joined = numbered.join(stats, list(by))
    else:
        joined = numbered.crossJoin(F.broadcast(stats))  # stats has exactly one row
    rank = F.col("_wl_g") - F.col("_wl_s")
    n1 = F.col("_wl_n") - 1
    keep = F.lit(False)
    aggs = []
    for i, p in enumerate(probs):
        pos = n1 * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        keep = keep | (rank == lo) | (rank == hi)
        aggs.append(F.max(F.when(rank == lo, F.col("_wl_v"))).alias(f"_wl_a{i}"))
        aggs.append(F.max(F.when(rank == hi, F.col("_wl_v"))).alias(f"_wl_b{i}"))
    picked = joined.where(keep).groupBy(*by, "_wl_n").agg(*aggs)
    out = [F.col(c) for c in by]
    for i, p in enumerate(probs):
        pos = (F.col("_wl_n") - 1) * F.lit(float(p))
        t = pos - F.floor(pos)
        out.append(_lerp(F.col(f"_wl_a{i}"), F.col(f"_wl_b{i}"), t).alias(names[i]))
    return picked.select(*out)


def exact_median(df: DataFrame, value: str | Column, *, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    return exact_quantiles(df, value, [0.5], by=by, names=[name])


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """M1: exact medians of several columns, all from the same passes over the rows.

    The result has one value per column, so collecting it is bounded. A
    column without values has None.
    """

    if not columns:
        return {}
    wide = df.select(*[
        F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)])
    row = _refine(wide, [(f"v{i}", 0.5) for i in range(len(columns))], [], 10_000, CANDIDATES).first()
    if row["ok"]:
        return {c: row[f"q{i}"] for i, c in enumerate(columns)}
    found = {c: exact_median(wide, f"v{i}").first() for i, c in enumerate(columns)}
    return {c: r[0] if r else None for c, r in found.items()}
