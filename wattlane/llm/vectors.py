"""Near-duplicate vectors: tiled comparison in the order of the principal components.

Vectors are rotated to principal components (a rotation keeps every product)
and dealt into tiles along the first one. A pair of tiles is one group of one
job, unless the tiles lie too far apart along that component for any link. In
a group, the leading components are multiplied first; what the rest can add
is at most the product of the suffix norms, so pairs that cannot reach the
threshold stop there, and only the others are computed in full, in double
precision and in the original coordinates. A group returns counts and a
spanning set of links, never all its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import stage
from wattlane.llm.graph import connected_components


@dataclass(frozen=True)
class VectorConfig:
    """``sample_values``: about so many numbers are sampled to fit the components, which only steer the pruning."""

    threshold: float = 0.95
    tile_rows: int = 4096
    strip_rows: int = 512
    lead_share: float = 0.25
    sample_values: int = 2_000_000
    slack: float = 1e-9


def usable(v: Column) -> Column:
    """Whether a vector can link: not null or empty, all components finite, not all zero."""

    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def _units(rows: list[bytes]) -> np.ndarray:
    """Vectors of length one, in double precision."""

    x = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _components(nodes: DataFrame, dim: int, count: int, cfg: VectorConfig) -> np.ndarray:
    """Rotation to principal components, of a hash sample of about ``sample_values`` numbers."""

    share = min(1.0, cfg.sample_values / dim / count)
    draw = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / float(1 << 30)
    rows = [bytes(r["vector"]) for r in nodes.where(draw < share).select("vector").collect()]
    if not rows:
        return np.eye(dim)
    x = _units(rows)
    return np.linalg.eigh(x.T @ x)[1][:, ::-1].copy()


def _local_labels(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest label that rows and columns of a link matrix reach within it."""

    top = np.iinfo(np.int64).max
    while True:
        a = np.minimum(left, np.where(links, right, top).min(axis=1))
        b = np.minimum(right, np.where(links, a[:, None], top).min(axis=0))
        if (a == left).all() and (b == right).all():
            return a, b
        left, right = a, b


def _compare(a: pd.DataFrame, b: pd.DataFrame, same: bool, rotation: np.ndarray, cfg: VectorConfig) -> pd.DataFrame:
    """(node, links, root): numbers of linked vectors by node, and links that join all that are linked."""

    xa, xb = _units(list(a["vector"])), _units(list(b["vector"]))
    na, nb = a["node"].to_numpy(), b["node"].to_numpy()
    ca, cb = a["copies"].to_numpy(), b["copies"].to_numpy()
    lead = max(1, math.ceil(cfg.lead_share * xa.shape[1]))
    la, lb = xa @ rotation[:, :lead], xb @ rotation[:, :lead]
    ra = np.sqrt(np.maximum(0, 1 - (la * la).sum(axis=1)) + cfg.slack)
    rb = np.sqrt(np.maximum(0, 1 - (lb * lb).sum(axis=1)) + cfg.slack)
    count_a, count_b, labels, pairs = np.zeros(len(na), np.int64), np.zeros(len(nb), np.int64), nb.copy(), []
    for at in range(0, len(na), cfg.strip_rows):
        strip = slice(at, at + cfg.strip_rows)
        bound = la[strip] @ lb.T
        bound += ra[strip, None] * rb
        alive = bound >= cfg.threshold - cfg.slack
        if same:
            alive[np.arange(alive.shape[0]), np.arange(at, at + alive.shape[0])] = False
        rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if not len(rows):
            continue
        alive = alive[np.ix_(rows, cols)]
        i, j = np.nonzero(alive)
        if 8 * len(i) > alive.size:
            links = alive & (xa[at + rows] @ xb[cols].T >= cfg.threshold)
        else:
            links = np.zeros_like(alive)
            for k in range(0, len(i), 16384):
                p, q = i[k : k + 16384], j[k : k + 16384]
                links[p, q] = np.einsum("ij,ij->i", xa[at + rows[p]], xb[cols[q]]) >= cfg.threshold
        keep_r, keep_c = links.any(axis=1), links.any(axis=0)
        if not keep_r.any():
            continue
        rows, cols, links = at + rows[keep_r], cols[keep_c], links[np.ix_(keep_r, keep_c)]
        count_a[rows] += links @ cb[cols]
        if not same:
            count_b[cols] += ca[rows] @ links
        before = labels[cols]
        own, labels[cols] = _local_labels(links, na[rows], before)
        pairs += [np.stack([na[rows], own]), np.stack([before, labels[cols]]), np.stack([nb[cols], labels[cols]])]
    parts = [pd.DataFrame({"node": na, "links": count_a, "root": na}), pd.DataFrame({"node": nb, "links": count_b, "root": nb})]
    out = pd.concat([p[p["links"] > 0] for p in parts])
    if pairs:
        joined = np.unique(np.concatenate(pairs, axis=1), axis=1)
        joined = joined[:, joined[0] != joined[1]]
        out = pd.concat([out, pd.DataFrame({"node": joined[0], "links": 0, "root": joined[1]})])
    return out.astype("int64")


def _tiles(placed: DataFrame, count: int, cfg: VectorConfig) -> tuple[list[float], np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of the tiles along the first component, and by tile: its parts before it, first and last part near it.

    A tile that the bounds could not cut (many equal places) is cut into parts
    by a hash, so a part holds about ``tile_rows`` vectors.
    """

    n = math.ceil(count / cfg.tile_rows)
    cuts = sorted(set(placed.approxQuantile("place", [k / n for k in range(1, n)], 0.1 / n))) if n > 1 else []

    def tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tile = np.searchsorted(cuts, batch.column(0).to_numpy(), side="right")
            yield pa.RecordBatch.from_arrays([pa.array(tile, pa.int64()), batch.column(0)], names=["tile", "place"])

    found = {r["tile"]: r for r in placed.select("place").mapInArrow(tiled, "tile long, place double").groupBy("tile").agg(
        F.count(F.lit(1)).alias("n"), F.min("place").alias("lo"), F.max("place").alias("hi")).collect()}
    reach = math.sqrt(2 - 2 * cfg.threshold) + cfg.slack
    tiles = len(cuts) + 1
    parts = np.array([math.ceil(found[t]["n"] / (1.25 * cfg.tile_rows)) if t in found else 0 for t in range(tiles)])
    lo = np.array([found[t]["lo"] if t in found else math.inf for t in range(tiles)])
    hi = np.array([found[t]["hi"] if t in found else -math.inf for t in range(tiles)])
    start = np.concatenate([[0], np.cumsum(parts)])
    first, last = np.zeros(tiles, int), np.zeros(tiles, int)
    for t in range(tiles):
        if t in found:
            near = np.flatnonzero((lo - hi[t] <= reach) & (lo[t] - hi <= reach))
            first[t], last[t] = start[near[0]], start[near[-1] + 1] - 1
    return cuts, start, first, last


def _linked(nodes: DataFrame, dim: int, count: int, cfg: VectorConfig) -> DataFrame:
    """(node, links, root) rows of all vectors of one dimension."""

    rotation = _components(nodes, dim, count, cfg)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                at = _units([bytes(v) for v in batch.column(1).to_pylist()]) @ rotation[:, 0]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], names=["node", "vector", "copies", "place"])

    placed = stage(nodes.select("node", "vector", "copies").mapInArrow(
        place, "node long, vector binary, copies long, place double"), "placed")
    cuts, start, first, last = _tiles(placed, count, cfg)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every vector once for each pair of parts that it belongs to."""

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                tile = np.searchsorted(cuts, part.column(3).to_numpy(), side="right")
                node = part.column(0).to_numpy()
                own = start[tile] + (node * 2654435761 & 0xFFFFFFFF) % np.maximum(1, np.diff(start)[tile])
                times = last[tile] - first[tile] + 1
                src = np.repeat(np.arange(len(node)), times)
                other = np.concatenate([np.arange(a, b + 1) for a, b in zip(first[tile], last[tile], strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(own[src], other)), pa.array(np.maximum(own[src], other)), pa.array(own[src]),
                     *[part.column(c).take(pa.array(src)) for c in range(3)]],
                    names=["i", "j", "own", "node", "vector", "copies"])

    dealt = placed.mapInArrow(deal, "i long, j long, own long, node long, vector binary, copies long")

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        i, j = group["i"].iat[0], group["j"].iat[0]
        left, right = group[group["own"] == i], group[group["own"] == j]
        if not len(left) or not len(right):
            return pd.DataFrame({"node": [], "links": [], "root": []}, dtype="int64")
        return _compare(left, right, bool(i == j), rotation, cfg)

    return dealt.groupBy("i", "j").applyInPandas(compare, "node long, links long, root long")


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                 cfg: VectorConfig | None = None) -> DataFrame:
    """vec_id, n_links, component_id (smallest linked vec_id, directly or not), kept; one row per row of ``vectors``.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing; neither do vectors of different lengths. Equal vectors
    are compared once and count each. Rows that repeat a vec_id are vectors of
    their own; rows with a null vec_id count as links but name no component.
    An empty table gives an empty result; other columns are not read.
    """

    cfg = cfg or VectorConfig()
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    good = rows.where(usable(F.col("v")))
    classes = good.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))

    @F.arrow_udf("binary")
    def packed(v: pa.Array) -> pa.Array:
        return pa.array([np.asarray(x.values.to_numpy(zero_copy_only=False), np.float64).tobytes() for x in v], pa.binary())

    classes = classes.select(F.col("v"), "rep", "copies", F.size("v").alias("dim"), packed("v").alias("vector"))
    nodes = stage(stage(classes, "classes").withColumn("node", F.monotonically_increasing_id()), "nodes")
    found: DataFrame | None = None
    for r in nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect():
        part = _linked(nodes.where(F.col("dim") == r["dim"]), r["dim"], r["n"], cfg)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    found = stage(found, "links")
    labels = connected_components(found.where("node != root"), "node", "root")
    counts = found.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.join(labels, "node", "left").join(counts, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    known = stage(known.select("v", "rep", "component",
                               (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "known")
    names = known.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_class = known.join(names, "component").select("v", "n_links", "component_id")
    out = rows.join(by_class, "v", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
