"""M4: random-forest forecaster.

100 trees, every feature considered at each split (as the reference's
defaults), median imputation from the exact distributed medians, bootstrap
draws, variance reduction, histogram splits (at most 32 bins a feature) and at
most 30 levels (the default here).  Predictions are statistically comparable
with the reference's, not bit-equal.

Rows become bin codes once; rows of equal codes and target are one row with a
count.  A row's weight in a tree is a Poisson draw from a digest of that row, so
no bootstrap copy is stored, and draws depend on neither partitions nor reruns.
While a node holds more than ``LOCAL_ROWS`` rows, its split comes from one
aggregate of histograms per level, for the nodes of all trees together; the
rows of each smaller node then go to one task, which grows the rest of that
branch, all nodes of a level at a time: by histograms, and where nodes hold a
few rows only by comparing these.  What the driver holds is the nodes above the
branches; the branches are a table, and prediction sends rows to them.  Rows
travel packed, many of them in one value, as there are as many as rows times
trees.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wattlane.functions.missing import known
from wattlane.operators.quantiles import column_medians
from wattlane.session import cut_lineage, shuffle_partitions

BINS = 32
LOCAL_ROWS = 1 << 18  # nodes of at most so many rows are grown by one task
PACKED_ROWS = 1 << 15  # rows packed together before they are sent
FEW = 4  # rows of a node that are compared with each other
NODES = 2048  # nodes whose histograms are looked through together
RANK = np.arange(255, 0, -1, dtype=np.uint8)[:, None]
HISTOGRAM_BYTES = 1 << 26  # of one task, in one pass over the rows
TIE = 1 - 1e-9  # gains closer than this are equal and the first of them is taken, whatever the order of sums
#: branches by tree and the number of their root; root -1 is the part of the tree above its branches
TREES = "tree INT, root INT, nodes BINARY"
NODE = np.dtype([("feature", "<i2"), ("bin", "u1"), ("left", "<i4"), ("value", "<f8")])  # right child: left + 1; leaf: feature -1


def _codes(column: pd.Series, features: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, features)


def _numbers(column: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), kind)


def _together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The batches, ``PACKED_ROWS`` rows or more at a time."""

    held, n = [], 0
    for pdf in batches:
        held.append(pdf)
        n += len(pdf)
        if n >= PACKED_ROWS:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if n:
        yield pd.concat(held, ignore_index=True)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, list[int], list[int]]:
    """The order that brings equal keys together, rows as they were, and where each run begins and ends in it."""

    order = np.argsort(keys.astype(np.uint16) if keys.max() < 1 << 16 else keys, kind="stable")  # short keys sort by radix
    sorted_ = keys[order]
    cut = np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1
    return order, [0, *cut.tolist()], [*cut.tolist(), len(keys)]


def _stored(nodes: np.ndarray) -> bytes:
    """Nodes as text of a table: all features, the bins of inner nodes, the values of leaves; children follow in order."""

    inner = nodes["feature"] >= 0
    return nodes["feature"].tobytes() + nodes["bin"][inner].tobytes() + nodes["value"][~inner].tobytes()


def _restored(text: bytes) -> np.ndarray:
    """Nodes from ``_stored``: there is one leaf more than inner nodes, and the children of the k-th inner node are 2k+1, 2k+2."""

    inners = (len(text) - 10) // 13
    nodes = np.zeros(2 * inners + 1, NODE)
    nodes["feature"] = np.frombuffer(text, "<i2", 2 * inners + 1)
    inner = nodes["feature"] >= 0
    nodes["bin"][inner] = np.frombuffer(text, "u1", inners, 2 * (2 * inners + 1))
    nodes["value"][~inner] = np.frombuffer(text, "<f8", inners + 1, 2 * (2 * inners + 1) + inners)
    nodes["left"][inner] = 2 * np.arange(inners) + 1
    return nodes


def _route(nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The node without children that each row ends at."""

    step = nodes["feature"].astype(np.int64) << 40 | nodes["bin"].astype(np.int64) << 32 | nodes["left"].astype(np.int64) & 0xFFFFFFFF
    flat, width = codes.ravel(), codes.shape[1]
    ends, rows, at = np.zeros(len(codes), np.int64), np.arange(len(codes)), np.zeros(len(codes), np.int64)
    while len(rows):
        here = step.take(at)
        inner = np.flatnonzero(here >= 0)
        if len(inner) < len(rows):
            ends[rows] = at
            rows, here = rows.take(inner), here.take(inner)
        at = (here & 0xFFFFFFFF) + (flat.take(rows * width + (here >> 40)) > (here >> 32 & 255))
    return ends


class _Draws:
    """Bootstrap weights: what Poisson draws of rate 1 for each of the row's copies add up to, from a digest of the row."""

    def __init__(self, seed: int) -> None:
        self.seed, self.tables, self.seen, self.alike = seed, {}, None, []

    def _table(self, rate: int) -> tuple[int, np.ndarray]:
        if rate not in self.tables:
            spread = 12 * math.sqrt(rate) + 20
            first = max(0, int(rate - spread))
            p = [math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) for k in range(first, int(rate + spread))]
            self.tables[rate] = first, np.cumsum(p)
        return self.tables[rate]

    def weights(self, digest: np.ndarray, copies: np.ndarray, tree: int) -> np.ndarray:
        with np.errstate(over="ignore"):  # splitmix64
            z = digest.view(np.uint64) + np.uint64((self.seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2**64)
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2**53
        if copies is not self.seen:  # rows by their copies, for all trees
            order, begin, end = _runs(copies)
            self.seen, self.alike = copies, [(int(copies[order[i]]), order[i:j]) for i, j in zip(begin, end)]
        out = np.empty(len(u))
        for rate, of in self.alike:
            first, table = self._table(rate)
            out[of] = first + np.searchsorted(table, u[of], side="right")
        return out


class _Best:
    """The best split of each node of a level; of equal ones the first feature's, and of its the one of the lowest bin."""

    def __init__(self, width: int) -> None:
        self.score, self.feature, self.bin = np.zeros(width), np.full(width, -1, np.int16), np.zeros(width, np.uint8)

    def offer(self, nodes: np.ndarray, feature: int, score: np.ndarray, bins: np.ndarray) -> None:
        hit = np.flatnonzero(TIE * score > self.score[nodes])
        at = nodes[hit]
        self.score[at], self.feature[at], self.bin[at] = score[hit], feature, bins[hit]


def _gains(left: np.ndarray, s: np.ndarray, total: np.ndarray) -> np.ndarray:
    """s * s / (left * right), in ``s``: the gain of a cut, but for the node's weight.

    Weights are whole numbers, so a product under 1 has an empty side; s is nothing there but what rounding left.
    """

    left *= total - left
    s *= s
    s /= np.maximum(left, 0.5, out=left)
    return s


def _scan(best: _Best, nodes: np.ndarray, counts: np.ndarray, weight: np.ndarray, codes: np.ndarray, w: np.ndarray,
          d: np.ndarray, bins: np.ndarray) -> None:
    """Offers the best cuts of nodes by histograms; rows are in the order of nodes."""

    ends = np.cumsum(counts)
    for first in range(0, len(nodes), NODES):
        part = slice(first, first + NODES)
        k = len(nodes[part])
        rows = slice(ends[first] - counts[first], ends[first + k - 1])
        node, total = np.repeat(np.arange(k), counts[part]), weight[part]
        for f, b in enumerate(bins):
            if b < 2:
                continue
            cell = np.multiply(codes[rows, f], k, dtype=np.int64)
            cell += node
            left = np.bincount(cell, w[rows], k * b).reshape(b, k)[:-1]
            s = np.bincount(cell, d[rows], k * b).reshape(b, k)[:-1]
            for i in range(1, b - 1):
                left[i] += left[i - 1]
                s[i] += s[i - 1]
            score = _gains(left, s, total)
            top = score.max(axis=0)
            best.offer(nodes[part], f, top, 255 - ((score >= TIE * top) * RANK[:b - 1]).max(axis=0))


def _compare(best: _Best, nodes: np.ndarray, rows: np.ndarray, weight: np.ndarray, codes: np.ndarray, w: np.ndarray,
             d: np.ndarray) -> None:
    """Offers the best cuts of nodes of equally few rows, given by column, by comparing each row with the others."""

    for first in range(0, len(nodes), NODES):
        part = slice(first, first + NODES)
        at = rows[:, part]
        code = np.ascontiguousarray(codes[at].transpose(0, 2, 1))
        wt, dt, score = w[at], d[at], np.empty(code.shape)
        for i in range(len(at)):
            left, s = np.zeros(code.shape[1:]), np.zeros(code.shape[1:])
            for j in range(len(at)):
                under = code[j] <= code[i]
                left += np.where(under, wt[j], 0.0)
                s += np.where(under, dt[j], 0.0)
            score[i] = _gains(left, s, weight[part])
        top = score.max(axis=0)
        low = np.where(score >= TIE * top, code, np.uint8(255)).min(axis=0)
        for f in range(code.shape[1]):
            best.offer(nodes[part], f, top[f], low[f])


def _grow(codes: np.ndarray, y: np.ndarray, w: np.ndarray, levels: int) -> np.ndarray:
    """The nodes of one branch of at most ``levels`` splits in depth; all nodes of a level at a time, rows in their order."""

    features, bins = codes.shape[1], codes.max(axis=0).astype(np.int64) + 1
    done, total, counts, order = [], 1, np.array([len(y)]), None
    for level in range(levels + 1):
        width = len(counts)
        starts = np.cumsum(counts) - counts
        node = np.repeat(np.arange(width), counts)
        out = np.zeros(width, NODE)
        out["feature"] = -1
        low, high = np.minimum.reduceat(y, starts), np.maximum.reduceat(y, starts)
        weight = np.bincount(node, w, width)
        mean = np.where(low == high, low, np.bincount(node, w * y, width) / weight)
        out["value"] = mean
        done.append(out)
        mixed = low < high
        if level == levels or not mixed.any():
            break
        if not mixed.all():  # rows of leaves go
            live = np.flatnonzero(mixed[node])
            order = live if order is None else order.take(live)
            y, w, node = y.take(live), w.take(live), node.take(live)
            counts = np.where(mixed, counts, 0)
            starts = np.cumsum(counts) - counts
        if order is not None:
            codes = codes.take(order, axis=0)
        d = w * (y - mean.take(node))
        best = _Best(width)
        for few in range(2, FEW + 1):
            nodes = np.flatnonzero(counts == few)
            if len(nodes):
                _compare(best, nodes, starts[nodes] + np.arange(few)[:, None], weight[nodes], codes, w, d)
        nodes = np.flatnonzero(counts > FEW)
        if len(nodes):
            rows = slice(None) if len(nodes) == np.count_nonzero(counts) else np.flatnonzero((counts > FEW)[node])
            _scan(best, nodes, counts[nodes], weight[nodes], codes[rows], w[rows], d[rows], bins)
        split = best.score * weight > 1e-12 * np.bincount(node, d * d / w, width)
        if not split.any():
            break
        out["feature"][split], out["bin"][split] = best.feature[split], best.bin[split]
        out["left"][split] = total + 2 * np.arange(split.sum())
        column = np.maximum(best.feature, 0).astype(np.int64)
        right = codes.ravel().take(np.arange(0, codes.size, features) + column.take(node)) > best.bin.take(node)
        kept = split[node]
        sides = np.flatnonzero(kept & ~right), np.flatnonzero(kept & right)
        n_left, n_right = (np.bincount(node[x], minlength=width)[split] for x in sides)
        order = np.empty(sum(map(len, sides)), np.int64)  # left and right rows of each node, as they stood
        order[np.arange(len(sides[0])) + np.repeat(np.cumsum(n_right) - n_right, n_left)] = sides[0]
        order[np.arange(len(sides[1])) + np.repeat(np.cumsum(n_left), n_right)] = sides[1]
        counts = np.stack([n_left, n_right], axis=1).ravel()
        y, w = y.take(order), w.take(order)
        total += len(counts)
    return np.concatenate(done)


def _best_split(hist: np.ndarray) -> tuple[int, int, float, float, int, float, float, int]:
    """(feature, bin; weight, mean and rows of either side) by a (3, features, bins) histogram; feature -1: no gain."""

    w, s, n = np.cumsum(hist, axis=2)[:, :, :-1]
    total, moment, rows = hist[:, 0].sum(axis=1)
    right, rest = total - w, moment - s
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where((w > 0) & (right > 0), s * s / w + rest * rest / right - moment * moment / total, 0.0)
    f, b = np.unravel_index(int(np.argmax(gain >= TIE * gain.max())), gain.shape)
    if not gain[f, b] > 1e-12 * moment * moment / total:
        return -1, 0, total, moment / total, int(rows), 0.0, 0.0, 0
    return (int(f), int(b), w[f, b], s[f, b] / w[f, b], int(n[f, b]), right[f, b], rest[f, b] / right[f, b], int(rows - n[f, b]))


@dataclass
class ForestModel:
    feature_names: list[str]
    trees: DataFrame | None  # TREES
    cuts: list[list[float]] = field(default_factory=list)  # by feature; a code is the number of cuts below the value
    num_trees: int = 100
    medians: dict[str, float | None] = field(default_factory=dict)
    model_type: str = "random_forest"
    target_column: str = "target_load_mw"
    forecast_horizon: int = 24
    random_state: int | None = 42

    def _imputed(self) -> list[Column]:
        cols = []
        for i, f in enumerate(self.feature_names):
            x = known(f)
            med = self.medians.get(f)
            cols.append((F.coalesce(x, F.lit(med)) if med is not None else x).alias(f"_wl_f_{i}"))
        return cols

    def _binned(self, df: DataFrame, key: str, kind: str) -> DataFrame:
        """``key`` and the codes of a row, a byte per feature."""

        cuts = [np.array(c, float) for c in self.cuts]
        names = [f"_wl_f_{i}" for i in range(len(cuts))]

        def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                codes = np.stack([np.searchsorted(c, pdf[n].to_numpy(float, na_value=np.nan)) for c, n in zip(cuts, names, strict=True)],
                                 axis=1).astype(np.uint8)
                yield pd.DataFrame({"key": pdf["key"], "codes": [r.tobytes() for r in codes]})

        return df.select(F.col(key).alias("key"), *self._imputed()).mapInPandas(code, f"key {kind}, codes BINARY")

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """Writes ``df`` with row ids to the shared folder; every row meets its branch of each tree by a shuffle."""

        missing = [f for f in self.feature_names if f not in df.columns]
        if missing:
            raise ValueError(f"Missing required model features: {', '.join(missing)}.")
        spark = df.sparkSession
        slots = spark.sparkContext.defaultParallelism
        spread = df.repartition(max(2 * slots, shuffle_partitions(spark)))  # the rows of a split may stand in few partitions
        stamped = cut_lineage(spread.withColumn("_wl_id", F.monotonically_increasing_id()))
        binned = self._binned(stamped, "_wl_id", "LONG")
        tops = {r["tree"]: _restored(r["nodes"]) for r in self.trees.where(F.col("root") < 0).collect()}
        features, trees = len(self.feature_names), self.num_trees
        chunk = max(1, min(1 << 16, (1 << 21) // trees))  # ids whose values, one per tree, meet in one task

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            found = {t: np.zeros(len(top), np.int64) for t, top in tops.items()}
            for pdf in batches:
                codes = _codes(pdf["codes"], features)
                for t, top in tops.items():
                    found[t] += np.bincount(_route(top, codes), minlength=len(top))
            for t, n in found.items():
                at = np.flatnonzero(n)
                yield pd.DataFrame({"tree": t, "root": at, "n": n[at]})

        sizes = binned.mapInPandas(count, "tree INT, root INT, n LONG").groupBy("tree", "root").agg(F.sum("n").alias("n"))
        sizes = sizes.select("tree", "root", "n", F.ceil(F.col("n") / LOCAL_ROWS).cast("int").alias("parts")).toPandas()
        parts = {t: np.ones(len(top), np.int64) for t, top in tops.items()}  # rows of a full branch go to several tasks
        for t, part in sizes.groupby("tree"):
            parts[t][part["root"]] = part["parts"]

        def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in _together(batches):
                codes, key = _codes(pdf["codes"], features), pdf["key"].to_numpy()
                of, place = key // chunk, (key % chunk).astype("<u2")
                near = np.unique(of, return_inverse=True)[1]
                for t, top in tops.items():
                    root = _route(top, codes)
                    order, begin, end = _runs(root * (near.max() + 1) + near)
                    first, sent, places = order[begin], codes.take(order, axis=0), place[order]
                    yield pd.DataFrame({
                        "tree": t, "root": root[first], "part": of[first] % parts[t][root[first]], "chunk": of[first],
                        "place": [places[i:j].tobytes() for i, j in zip(begin, end)],
                        "codes": [sent[i:j].tobytes() for i, j in zip(begin, end)]})

        def walk(branch: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            if not len(rows):
                return pd.DataFrame({"chunk": [], "tree": [], "place": [], "value": []})
            nodes = _restored(branch["nodes"].iloc[0])
            values = nodes["value"].take(_route(nodes, _codes(rows["codes"], features)))
            ends = np.cumsum([len(x) // 2 for x in rows["place"]]).tolist()
            return pd.DataFrame({"chunk": rows["chunk"], "tree": rows["tree"], "place": rows["place"],
                                 "value": [values[i:j].tobytes() for i, j in zip([0, *ends], ends)]})

        def mean(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            places = _numbers(pdf["place"], "<u2")
            tree = np.repeat(pdf["tree"].to_numpy(), [len(x) // 2 for x in pdf["place"]])
            ids, row = np.unique(places, return_inverse=True)
            values = np.empty((len(ids), trees))
            values[row, tree] = _numbers(pdf["value"], "<f8")
            values.sort(axis=1)  # added in one order whatever task sent them first
            total = np.zeros(len(ids))
            for k in range(trees):
                total += values[:, k]
            return pd.DataFrame({"_wl_id": int(key[0]) * chunk + ids.astype(np.int64), "_wl_pred": total / trees})

        rows = int(sizes["n"].sum())
        tasks = max(1, min(len(sizes), max(8 * slots, math.ceil(rows / LOCAL_ROWS))))
        keys = ["tree", "root", "part"]
        split = spark.createDataFrame(sizes[["tree", "root", "parts"]], "tree INT, root INT, parts INT")
        branches = self.trees.join(F.broadcast(split), ["tree", "root"]).select(
            "tree", "root", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)).alias("part"), "nodes")
        sent = binned.mapInPandas(send, "tree INT, root INT, part LONG, chunk LONG, place BINARY, codes BINARY")
        values = branches.repartition(tasks, *keys).groupBy(*keys).cogroup(
            sent.repartition(tasks, *keys).groupBy(*keys)).applyInPandas(walk, "chunk LONG, tree INT, place BINARY, value BINARY")
        found = values.groupBy("chunk").applyInPandas(mean, "_wl_id LONG, _wl_pred DOUBLE")
        return stamped.join(found, "_wl_id").drop("_wl_id").withColumnRenamed("_wl_pred", name)

    # The trees, and beside them one row of what prediction needs besides
    def save(self, path: str) -> str:
        spark = SparkSession.getActiveSession()
        self.trees.write.mode("overwrite").parquet(f"{path}/trees")
        meta = json.dumps({k: getattr(self, k) for k in self.__dataclass_fields__ if k != "trees"})
        spark.createDataFrame([(meta,)], "value STRING").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> "ForestModel":
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        return ForestModel(trees=spark.read.schema(StructType.fromDDL(TREES)).parquet(f"{path}/trees"), **meta)


def _cuts(x: DataFrame) -> list[list[float]]:
    """At most 31 cuts per column: between all values where there are no more than 32, else quantiles."""

    probs = F.array(*[F.lit(k / BINS) for k in range(1, BINS)])
    row = x.agg(*[F.percentile_approx(c, probs, 10_000).alias(f"q_{c}") for c in x.columns],
                *[F.approx_count_distinct(c).alias(f"n_{c}") for c in x.columns]).first()
    few = [c for c in x.columns if row[f"n_{c}"] <= 1.5 * BINS]
    values = x.agg(*[F.collect_set(c).alias(c) for c in few]).first().asDict() if few else {}
    out = []
    for c in x.columns:
        seen = sorted(values.get(c, ()))
        if c in values and len(seen) <= BINS:
            out.append([(a + b) / 2 if math.isfinite(a + b) else a for a, b in zip(seen, seen[1:])])
        else:
            out.append(sorted(set(row[f"q_{c}"])))
    return out


def _top_levels(rows: DataFrame, count: int, features: int, trees: int, levels: int, seed: int) -> tuple[dict, dict]:
    """The nodes of each tree above its branches, and the depth of those nodes; ``rows``: y, n, codes, digest."""

    nodes = {t: [(-1, 0, 0, 0.0)] for t in range(trees)}
    depth = {t: [0] for t in range(trees)}
    open_ = [(t, 0) for t in range(trees)] if count > LOCAL_ROWS else []
    per_pass = max(1, HISTOGRAM_BYTES // (3 * features * BINS * 8))

    def pass_over(some: list[tuple[int, int]]) -> pd.DataFrame:
        tops = {t: np.array(nodes[t], NODE) for t in {t for t, _ in some}}
        place = {t: np.full(len(top), -1) for t, top in tops.items()}
        wanted = {t: [] for t in tops}
        for t, k in some:
            wanted[t].append(k)
        for t, ks in wanted.items():
            place[t][ks] = np.arange(len(ks))

        def histograms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            draws, found = _Draws(seed), {t: np.zeros((len(ks), 3, features, BINS)) for t, ks in wanted.items()}
            for pdf in _together(batches):
                codes, y, n, digest = (_codes(pdf["codes"], features), *(pdf[c].to_numpy() for c in ("y", "n", "digest")))
                for t, top in tops.items():
                    w = draws.weights(digest, n, t)
                    at = place[t][_route(top, codes)]
                    of = np.flatnonzero((w > 0) & (at >= 0))
                    a, size, here, weight = at[of] * BINS, len(wanted[t]) * BINS, codes.take(of, axis=0), w.take(of)
                    sums = weight, weight * y.take(of), None
                    for f in range(features):
                        cell = a + here[:, f]
                        for j, v in enumerate(sums):
                            found[t][:, j, f] += np.bincount(cell, v, size).reshape(-1, BINS)
            for t, h in found.items():
                yield pd.DataFrame({"tree": t, "node": wanted[t], "histogram": [x.tobytes() for x in h]})

        def best(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            hist = np.zeros((3, features, BINS))
            for b in sorted(pdf["histogram"]):  # sums in one order, whatever the shuffle's
                hist += np.frombuffer(b).reshape(hist.shape)
            return pd.DataFrame([(int(key[0]), int(key[1]), *_best_split(hist))], columns=found_columns)

        found_columns = ["tree", "node", "feature", "bin", "lw", "lm", "ln", "rw", "rm", "rn"]
        return rows.mapInPandas(histograms, "tree INT, node INT, histogram BINARY").groupBy("tree", "node").applyInPandas(
            best, "tree INT, node INT, feature INT, bin INT, lw DOUBLE, lm DOUBLE, ln LONG, rw DOUBLE, rm DOUBLE, rn LONG").toPandas()

    while open_:
        grown = pd.concat([pass_over(open_[i:i + per_pass]) for i in range(0, len(open_), per_pass)])
        open_ = []
        for r in grown.sort_values(["tree", "node"]).itertuples():
            if r.feature < 0 or levels == 0:  # left -1: a leaf, however many rows it holds
                nodes[r.tree][r.node] = (-1, 0, -1, (r.lw * r.lm + r.rw * r.rm) / (r.lw + r.rw))
                continue
            left = len(nodes[r.tree])
            nodes[r.tree][r.node] = (r.feature, r.bin, left, 0.0)
            d = depth[r.tree][r.node] + 1
            for k, mean, n in ((left, r.lm, r.ln), (left + 1, r.rm, r.rn)):
                nodes[r.tree].append((-1, 0, -1 if d == levels else 0, mean))
                depth[r.tree].append(d)
                if d < levels and n > LOCAL_ROWS:
                    open_.append((r.tree, k))
    return {t: np.array(v, NODE) for t, v in nodes.items()}, {t: np.array(v) for t, v in depth.items()}


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    *,
    num_trees: int = 100,
    max_depth: int = 30,
    random_state: int = 42,
    forecast_horizon: int = 24,
) -> ForestModel:
    features = list(features)
    if not features:
        raise ValueError("feature_names must not be empty.")
    spark, levels, width = df.sparkSession, min(max_depth, 30), len(features)
    model = ForestModel(features, None, num_trees=num_trees, medians=column_medians(df, features), target_column=target,
                        forecast_horizon=forecast_horizon, random_state=random_state)
    taught = df.where(known(target).isNotNull()).withColumn("_wl_y", known(target))
    model.cuts = _cuts(taught.select(*model._imputed()))
    rows = model._binned(taught, "_wl_y", "DOUBLE").groupBy("codes", F.col("key").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    rows = cut_lineage(rows.select("y", "n", "codes", F.xxhash64("codes", "y").alias("digest")))
    count, slots = rows.count(), spark.sparkContext.defaultParallelism
    if count == 0:
        raise ValueError("No rows with a target to grow a forest from.")
    parts = max(2 * slots, math.ceil(count / (4 * LOCAL_ROWS)))  # tasks that send histograms grow slower than the rows
    rows = rows.repartition(parts, "digest")
    middle = rows.agg(F.sum(F.col("y") * F.col("n")) / F.sum("n")).first()[0]  # sums of centred targets keep their digits
    rows = cut_lineage(rows.withColumn("y", F.col("y") - F.lit(middle)))
    tops, depth = _top_levels(rows, count, width, num_trees, levels, random_state)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        draws = _Draws(random_state)
        for pdf in _together(batches):
            codes, y, n, digest = (_codes(pdf["codes"], width), *(pdf[c].to_numpy() for c in ("y", "n", "digest")))
            for t, top in tops.items():
                w = draws.weights(digest, n, t)
                root = _route(top, codes)
                of = np.flatnonzero((w > 0) & (top["left"][root] >= 0))
                if not len(of):
                    continue
                order, begin, end = _runs(root[of])
                of = of[order]
                packed = {"codes": codes.take(of, axis=0), "y": y[of], "w": w[of].astype("<u4")}
                yield pd.DataFrame({"tree": t, "root": root[of[begin]], "first": digest[0],
                                    **{c: [x[i:j].tobytes() for i, j in zip(begin, end)] for c, x in packed.items()}})

    def branch(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        t, root = int(key[0]), int(key[1])
        pdf = pdf.sort_values("first")  # sums in one order, that of all digests, whatever the partitions
        grown = _grow(_codes(pdf["codes"], width), _numbers(pdf["y"], "<f8"), _numbers(pdf["w"], "<u4").astype(float),
                      levels - int(depth[t][root]))
        grown["value"] += middle
        return pd.DataFrame({"tree": [t], "root": [root], "nodes": [_stored(grown)]})

    ends = {(t, int(k)) for t, top in tops.items() for k in np.flatnonzero((top["feature"] < 0) & (top["left"] >= 0))}
    tasks = max(1, min(len(ends), max(8 * slots, math.ceil(count * num_trees / LOCAL_ROWS))))
    drawn = rows.repartitionByRange(parts, "digest").sortWithinPartitions("digest").mapInPandas(
        draw, "tree INT, root INT, first LONG, codes BINARY, y BINARY, w BINARY")
    grown = drawn.repartition(tasks, "tree", "root").groupBy("tree", "root").applyInPandas(branch, TREES)
    above = []
    for t, top in tops.items():
        top["value"] += middle
        above.append((t, -1, _stored(top)))
        for k in np.flatnonzero((top["feature"] < 0) & (top["left"] < 0)):
            above.append((t, int(k), _stored(top[[k]])))
    trees = cut_lineage(grown.unionByName(spark.createDataFrame(above, TREES)))
    # a tree of few rows may have drawn none
    bare = ends - {tuple(r) for r in trees.where(F.col("root") >= 0).select("tree", "root").collect()}
    if bare:
        leaf = _stored(np.array([(-1, 0, 0, middle)], NODE))
        trees = trees.unionByName(spark.createDataFrame([(*k, leaf) for k in sorted(bare)], TREES))
    model.trees = trees
    return model
