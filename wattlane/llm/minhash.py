"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard verification.

Signature. A shingle's 64-bit hash is folded into a universe of ``2**universe_bits``
places and moved by a first permutation; coordinate ``k`` of the signature is
the minimum, over the document's places, of a second permutation shifted
circularly by ``k``. So two stored permutations give any number of coordinates.

Candidates. Documents with equal shingle sets are one class. Classes that
share a band of the signature share a bucket.

1. Every member of a bucket is checked against the bucket's smallest member.
2. In buckets that still hold several components, signatures are compared,
   and the likeliest links between components, a forest, are checked.
3. Where such a link failed, the cluster of documents that possible links join
   is compared block by block, on signatures, then on full sets.

All checks are on full shingle sets, and no step returns more pairs than it
has rows. A link is missed only if all bands miss it (5e-6 at the threshold
itself, less above) or the estimate falls below the floor (1e-5 there).
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import stage
from wattlane.llm.graph import connected_components


@dataclass(frozen=True)
class MinHashConfig:
    """``estimate_floor`` lies over four standard deviations of the estimate below the threshold."""

    shingle_words: int = 5
    threshold_pct: int = 75
    bands: int = 32
    rows: int = 4
    universe_bits: int = 20
    seed: int = 20240117
    estimate_floor: float = 0.58
    block: int = 256
    bundle_rows: int = 20_000

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows


class _WordHashes(dict):
    """64-bit hash by word; forgets all words when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h


_WORDS = _WordHashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@functools.lru_cache(maxsize=8)
def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; words are ASCII-lower-cased runs of non-blank characters."""

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    n = len(words) - width + 1
    factors = _odd(size, 5)
    total = np.full(n, width, np.uint64)
    for j in range(width):
        total += h[j : j + n] * factors[j]
    return np.unique(_mixed(total))


@functools.lru_cache(maxsize=2)
def _permutations(cfg: MinHashConfig) -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and the second one as rows of its circular shifts (a view)."""

    rng = np.random.default_rng(cfg.seed)
    size = 1 << cfg.universe_bits
    first = rng.permutation(size).astype(np.uint32)
    second = rng.permutation(size).astype(np.uint32)
    return first, sliding_window_view(np.concatenate([second, second[: cfg.coordinates - 1]]), cfg.coordinates)


def signature(shingles: np.ndarray, cfg: MinHashConfig) -> np.ndarray:
    """Circulant MinHash of a non-empty shingle set."""

    first, shifted = _permutations(cfg)
    places = first[(shingles & np.uint64((1 << cfg.universe_bits) - 1)).astype(np.int64)]
    out = np.full(cfg.coordinates, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(places), 256):
        np.minimum(out, shifted[places[i : i + 256]].min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray, cfg: MinHashConfig) -> np.ndarray:
    rows = sig.astype(np.uint64).reshape(cfg.bands, cfg.rows)
    return _mixed((rows * _odd(cfg.rows, 6)).sum(axis=1, dtype=np.uint64) + _odd(cfg.bands, 7)).view(np.int64)


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
                     ("bands", pa.list_(pa.int64())), ("sig", pa.binary())])


def _sign(docs: DataFrame, cfg: MinHashConfig) -> DataFrame:
    """doc_id, set size, digest of the set, band keys and 16-bit signature (all null for an empty set)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                n, digests, bands, sigs = [], [], [], []
                for t in part.column(1):
                    s = shingle_set(t.as_py(), cfg.shingle_words)
                    n.append(len(s))
                    if len(s):
                        sig = signature(s, cfg)
                        digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                        bands.append(band_keys(sig, cfg))
                        sigs.append(sig.astype(np.uint16).tobytes())
                    else:
                        digests.append(None), bands.append(None), sigs.append(None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())], schema=_SIGNED)

    return docs.mapInArrow(sign, "doc_id long, n long, digest binary, bands array<long>, sig binary")


def _linked(a: np.ndarray, b: np.ndarray, cfg: MinHashConfig) -> bool:
    """Whether two full shingle sets reach the threshold."""

    common = len(np.intersect1d(a, b, assume_unique=True))
    return len(a) > 0 and 100 * common >= cfg.threshold_pct * (len(a) + len(b) - common)


def _similar(cfg: MinHashConfig):
    """Column function: whether two texts' full shingle sets reach the threshold."""

    @F.arrow_udf("boolean")
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        sets = functools.lru_cache(maxsize=32)(lambda t: shingle_set(t, cfg.shingle_words))
        found = [_linked(sets(x.as_py()), sets(y.as_py()), cfg) for x, y in zip(left, right, strict=True)]
        return pa.array(found, pa.bool_())

    return similar


def _verified(pairs: DataFrame, texts: DataFrame, cfg: MinHashConfig) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose documents are linked."""

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a")
    return both.where(_similar(cfg)("text_a", "text_b")).select("a", "b")


def _alike(sig: np.ndarray, n: np.ndarray, comp: np.ndarray, x: np.ndarray, y: np.ndarray,
           cfg: MinHashConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the row pairs (x, y), those of different components that could be linked, and their estimates."""

    fits = (100 * np.minimum(n[x], n[y]) >= cfg.threshold_pct * np.maximum(n[x], n[y])) & (comp[x] != comp[y])
    x, y = x[fits], y[fits]
    estimates = [np.empty(0)]
    for at in range(0, len(x), 4096):
        estimates.append((sig[x[at : at + 4096]] == sig[y[at : at + 4096]]).mean(axis=1))
    est = np.concatenate(estimates)
    near = est >= cfg.estimate_floor
    return x[near], y[near], est[near]


class _Forest:
    """Union-find over labels."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _columns(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sig = np.frombuffer(b"".join(group["sig"]), np.uint16).reshape(len(group), -1)
    return group["rep"].to_numpy(), group["n"].to_numpy(), group["comp"].to_numpy(), sig


def _block_pairs(own: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """All row pairs of blocks i and j, each once."""

    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    x, y = np.repeat(left, len(right)), np.tile(right, len(left))
    return (x[x < y], y[x < y]) if i == j else (x, y)


def _possible_links(members: DataFrame, bundles: int, cfg: MinHashConfig) -> DataFrame:
    """(a, b): a forest of likeliest links that joins all components with possible links in a bucket.

    ``members``: key, rep, n, sig, comp, blocks. Small buckets are dealt into
    ``bundles`` groups; a bucket of several blocks is cut into them, and each
    pair of its blocks is a group. So a group is bounded either way, and
    returns fewer pairs than it has rows.
    """

    several = F.col("blocks") > 1
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "key", "rep", "n", "sig", "comp", "own",
        F.when(several, F.col("key")).otherwise(F.pmod(F.xxhash64("key"), F.lit(bundles))).alias("bundle"),
        F.when(several, F.least("own", "other")).otherwise(-1).alias("i"),
        F.when(several, F.greatest("own", "other")).otherwise(-1).alias("j"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        i, j = group["i"].iat[0], group["j"].iat[0]
        if i < 0:
            group = group.sort_values("key", ignore_index=True)
        ids, n, comp, sig = _columns(group)
        if i < 0:
            key, found, apart = group["key"].to_numpy(), [], 1
            while len(at := np.flatnonzero(key[:-apart] == key[apart:])):
                found.append(_alike(sig, n, comp, at, at + apart, cfg))
                apart += 1
            x, y, est = map(np.concatenate, zip(*found, strict=True)) if found else (np.empty(0, int),) * 3
        else:
            x, y, est = _alike(sig, n, comp, *_block_pairs(group["own"].to_numpy(), i, j), cfg)
        forest, pairs = _Forest(), []
        for k in np.argsort(-est, kind="stable"):
            if forest.join(int(comp[x[k]]), int(comp[y[k]])):
                pairs.append(sorted((int(ids[x[k]]), int(ids[y[k]]))))
        return pd.DataFrame(np.array(pairs, np.int64).reshape(-1, 2), columns=["a", "b"])

    return dealt.groupBy("bundle", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def _settled(open_docs: DataFrame, bundles: int, cfg: MinHashConfig) -> DataFrame:
    """(a, b): links that join all components of a cluster between which there is a link, checked on full sets.

    ``open_docs``: cluster, size, rep, n, sig, comp, comp_size, text; one row a
    document. A cluster of up to a block is compared in one of ``bundles`` groups.
    A larger one is cut into blocks, a component of a block's size into its
    own ones, and each pair of blocks that isn't of one component alone is a group.
    """

    single = F.col("size") <= cfg.block
    small = open_docs.where(single).select(
        "*", F.pmod(F.xxhash64("cluster"), F.lit(bundles)).alias("g"), F.lit(-1).cast("long").alias("i"),
        F.lit(-1).cast("long").alias("j"), F.lit(-1).cast("long").alias("block"))
    big = open_docs.where(~single)
    pure = F.col("comp_size") >= cfg.block
    parts = F.ceil(F.when(pure, F.col("comp_size")).otherwise(F.col("size")) / cfg.block)
    deal = F.when(pure, F.pmod(F.xxhash64("rep"), parts)).otherwise(F.pmod(F.xxhash64("comp"), parts))
    big = big.withColumn("block", F.xxhash64(F.when(pure, F.col("comp")), deal))
    blocks = big.select("cluster", "block", F.when(pure, F.col("comp")).alias("only")).distinct()
    one = blocks.select("cluster", F.col("block").alias("i"), F.col("only").alias("only_i"))
    two = blocks.select("cluster", F.col("block").alias("j"), F.col("only").alias("only_j"))
    pairs = one.join(two, "cluster").where((F.col("i") <= F.col("j")) & F.coalesce(F.col("only_i") != F.col("only_j"), F.lit(True)))
    pairs = pairs.select("cluster", "i", "j").select(
        "cluster", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    spread = big.join(pairs, ["cluster", "block"]).withColumn("g", F.col("cluster"))
    columns = ["cluster", "rep", "n", "sig", "comp", "text", "g", "i", "j", "block"]

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("cluster", ignore_index=True)
        i, j = group["i"].iat[0], group["j"].iat[0]
        ids, n, comp, sig = _columns(group)
        if i == j == -1:
            at = group["cluster"].to_numpy()
            edges = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]]))
            found = []
            for lo, hi in zip(edges, edges[1:], strict=False):
                x, y = np.triu_indices(hi - lo, 1)
                found.append(_alike(sig, n, comp, x + lo, y + lo, cfg))
            x, y, est = map(np.concatenate, zip(*found, strict=True))
        else:
            x, y, est = _alike(sig, n, comp, *_block_pairs(group["block"].to_numpy(), i, j), cfg)
        texts = group["text"].to_numpy()
        sets = functools.lru_cache(maxsize=2 * cfg.block)(lambda k: shingle_set(texts[k], cfg.shingle_words))
        forest, links = _Forest(), []
        for k in np.argsort(-est, kind="stable"):
            p, q = int(x[k]), int(y[k])
            if forest.find(int(comp[p])) != forest.find(int(comp[q])) and _linked(sets(p), sets(q), cfg):
                forest.join(int(comp[p]), int(comp[q]))
                links.append((int(ids[p]), int(ids[q])))
        return pd.DataFrame(np.array(links, np.int64).reshape(-1, 2), columns=["a", "b"])

    return small.select(columns).union(spread.select(columns)).groupBy("g", "i", "j").applyInPandas(
        compare, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    cfg: MinHashConfig | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest linked doc_id, directly or not), kept; one row per row of ``docs``.

    Null or blank texts have no shingles and link with nothing. Rows that
    repeat a doc_id are one node of the link graph; a row whose doc_id is null
    is linked with nothing, has a null component and is kept. An empty table
    gives an empty result; other columns of ``docs`` are not read.
    """

    cfg = cfg or MinHashConfig()
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    signed = stage(_sign(docs, cfg), "signed")
    own = signed.where(F.col("n") > 0).where(F.col("doc_id").isNotNull())
    classes = own.groupBy("digest").agg(F.min("doc_id").alias("rep"))

    keyed = own.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    keyed = keyed.select("rep", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stage(keyed.join(buckets, "key"), "shared")
    named = shared.select(F.col("rep").alias("doc_id")).distinct()
    texts = stage(docs.join(named, "doc_id", "left_semi"), "texts")

    hub_pairs = shared.where("rep != hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    links = stage(_verified(hub_pairs, texts, cfg), "links")
    labels = connected_components(links)

    labelled = _labelled(shared, labels, "comp")
    mixed = labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    members = stage(labelled.join(mixed.select("key"), "key").select("key", "rep", "comp", "size"), "mixed")
    n_members = members.count()
    if n_members:
        sigs = own.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
        sigs = sigs.groupBy(F.col("doc_id").alias("rep")).agg(F.min(F.struct("n", "sig")).alias("s"))
        sigs = stage(sigs.select("rep", "s.n", "s.sig"), "sigs")
        blocks = F.ceil(F.col("size") / cfg.block).cast("int").alias("blocks")
        possible = stage(_possible_links(members.join(sigs, "rep").select("key", "rep", "comp", "n", "sig", blocks),
                                         1 + n_members // cfg.bundle_rows, cfg), "possible")
        links = stage(links.union(_verified(possible, texts, cfg)), "links")
        labels = connected_components(links)
        links = links.union(_unsettled_links(links, possible, labels, sigs, texts, cfg))
        labels = connected_components(links)

    ids = _labelled(classes, labels, "component_id").select("digest", "component_id")
    out = signed.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(ids, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _labelled(rows: DataFrame, labels: DataFrame, name: str) -> DataFrame:
    """``rows`` with the label of their ``rep``, itself where it has none."""

    found = rows.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    return found.withColumn(name, F.coalesce("component", "rep")).drop("component")


def _unsettled_links(links: DataFrame, possible: DataFrame, labels: DataFrame, sigs: DataFrame, texts: DataFrame,
                     cfg: MinHashConfig) -> DataFrame:
    """Further links inside the clusters that possible links join but checked ones so far don't."""

    clusters = connected_components(links.union(possible)).withColumnsRenamed({"node": "rep", "component": "cluster"})
    both = stage(_labelled(clusters, labels, "comp"), "clusters")
    open_ones = both.groupBy("cluster").agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo < hi")
    parts = both.groupBy("cluster", "comp").agg(F.count(F.lit(1)).alias("comp_size"))
    open_docs = both.join(open_ones.select("cluster", "size"), "cluster").join(parts, ["cluster", "comp"])
    whole = texts.groupBy(F.col("doc_id").alias("rep")).agg(F.min("text").alias("text"))
    open_docs = stage(open_docs.join(sigs, "rep").join(whole, "rep"), "open")
    n_open = open_ones.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    return stage(_settled(open_docs, 1 + n_open // cfg.block, cfg), "links")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                         cfg: MinHashConfig | None = None) -> DataFrame:
    """The documents, with all their columns, that are the smallest doc_id of their group.

    Rows equal in doc_id and text are one document, and one of them stays.
    Rows with a null doc_id, and rows without words, are never dropped for
    another document.
    """

    dropped = near_duplicates(docs, doc_id, text, cfg).where(~F.col("kept")).select(F.col("doc_id").alias("gone"))
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("id"), F.md5(F.col(text)).alias("same"))
    rows = rows.join(stage(dropped.distinct(), "dropped"), F.col("id") == F.col("gone"), "left_anti")
    if docs.groupBy(doc_id).count().where((F.col("count") > 1) & F.col(doc_id).isNotNull()).isEmpty():
        return rows.select("row.*")
    named = rows.where(F.col("id").isNotNull()).dropDuplicates(["id", "same"])
    return named.union(rows.where(F.col("id").isNull())).select("row.*")
