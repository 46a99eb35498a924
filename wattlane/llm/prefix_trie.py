"""Prefix trie of conversations with subtree sums by depth bands.

A node is a distinct sequence of first turns. Its key is the sum, modulo
2**40 in three lanes, of a digest of every turn and its place, so that keys of
all prefixes are running sums and even a very long conversation is cut into
blocks (two sequences share a key with odds of 2**-120).

Sums over subtrees go by bands of depth. A node explodes to its ancestors
inside its band alone, at most ``band`` rows. The roots of the bands form a tree
a ``band``-th as deep, whose totals are found the same way; they are then passed
to the ancestors in the band above. So the rounds grow with the logarithm of
the depth, and no row is exploded more than twice ``band`` times a round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlane.llm.common import placed, stage

KEY = ["depth", "ka", "kb"]
_LANE = 1 << 40


@dataclass(frozen=True)
class TrieConfig:
    """``block_rows`` (a multiple of ``band``): turns of one conversation that one window sums.

    ``hot_children``: from so many children on, a node hands its conv_id down by
    broadcast; from ``chunk_ids`` ending conversations on, their ids are digested
    in chunks. Both limits rise with the table, so that there are at most 1,000
    and 10,000 such nodes.
    """

    band: int = 8
    block_rows: int = 1 << 16
    hot_children: int = 10_000
    chunk_ids: int = 4_096


@dataclass(frozen=True)
class Branching:
    """Every conversation starts with the first turns of the first of its ``group``: crc32(its id) modulo ``most`` of them."""

    group: int = 5
    most: int = 9


def _turns(convs: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Turns as digests in their order, and their pieces (see ``placed``)."""

    who, said = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    rows = convs.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), who.alias("role"),
        F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, said)).alias("digest"),
        F.octet_length(said).cast("long").alias("bytes"))
    rows, pieces = placed(rows, ["conv_id"], ["turn", "role", "digest"])
    return rows.select("conv_id", "digest", "bytes", "piece", "at"), pieces


def _rebuilt(rows: DataFrame, pieces: DataFrame, rule: Branching | None) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth, digest, bytes, len) of every turn of the rebuilt conversations; (conv_id, len) of all of them."""

    convs = stage(pieces.groupBy("conv_id").agg(F.sum("n").alias("own")), "convs")
    if rule is None:
        convs = convs.select("conv_id", F.lit(0).alias("h"), F.lit(0).alias("lent"), F.col("own").alias("len"))
    else:
        first = F.col("conv_id") - F.pmod("conv_id", F.lit(rule.group))
        h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(rule.most))
        convs = convs.withColumns({"first": first, "h": F.when(F.col("conv_id") != first, h).otherwise(0)})
        lenders = convs.select(F.col("conv_id").alias("first"), F.col("own").alias("theirs"))
        lent = F.least("h", F.coalesce("theirs", F.lit(0)))
        convs = convs.join(lenders, "first", "left").select(
            "conv_id", "h", lent.alias("lent"), (lent + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len"))
    convs = stage(convs, "rebuilt")

    # a conversation has a row per piece, so the hottest one is joined piece by piece
    known = pieces.join(convs, "conv_id").select("piece", "conv_id", "shift", "h", "lent", "len")
    joined = rows.join(known, ["piece", "conv_id"]).withColumn("pos", F.col("at") + F.col("shift"))
    depth = F.col("pos") - F.col("h") + F.col("lent") + 1
    turns = joined.where("pos >= h").select("conv_id", depth.alias("depth"), "digest", "bytes", "len")
    if rule is None:
        return turns, convs
    heads = joined.where((F.col("pos") < rule.most - 1) & (F.pmod("conv_id", F.lit(rule.group)) == 0))
    heads = heads.select(F.explode(F.sequence(F.col("conv_id") + 1, F.col("conv_id") + rule.group - 1)).alias("conv_id"),
                         (F.col("pos") + 1).alias("depth"), "digest", "bytes")
    borrowed = heads.join(convs.select("conv_id", "lent", "len"), "conv_id").where("depth <= lent")
    return turns.unionByName(borrowed.drop("lent")), convs


def _above(rows: DataFrame, cfg: TrieConfig) -> DataFrame:
    """``rows`` with ``above``: keys of the ancestors from the root of the parent's band down to the parent."""

    order = Window.partitionBy("conv_id", F.expr(f"(depth - 1) div {cfg.block_rows}")).orderBy("depth")
    near = F.collect_list(F.struct(F.col("pka").alias("ka"), F.col("pkb").alias("kb"))).over(
        order.rowsBetween(1 - cfg.band, 0))
    many = (F.pmod(F.col("depth") - 1, F.lit(cfg.band)) + 1).cast("int")
    return rows.withColumn("near", near).withColumn("above", F.slice("near", F.size("near") - many + 1, many)).drop("near")


def _paths(turns: DataFrame, longest: int, cfg: TrieConfig) -> DataFrame:
    """conv_id, depth, ka, kb, pka, pkb, bytes, ends, above of every prefix of every conversation."""

    placed_digest = F.md5(F.concat("digest", F.lit(":"), F.col("depth").cast("string")))
    lanes = [F.conv(F.substring(placed_digest, 1 + 10 * i, 10), 16, 10).cast("long").alias(f"t{i}") for i in range(3)]
    block = F.expr(f"(depth - 1) div {cfg.block_rows}")
    rows = turns.select("conv_id", "depth", "bytes", (F.col("depth") == F.col("len")).cast("long").alias("ends"), *lanes,
                        block.alias("block"))
    order = Window.partitionBy("conv_id", block).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    sums = {f"s{i}": F.pmod(F.sum(f"t{i}").over(order), F.lit(_LANE)) for i in range(3)}
    rows = rows.withColumns(sums)
    if longest > cfg.block_rows:  # what the earlier blocks of the conversation add up to
        rows = stage(rows, "blocks")
        before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
        full = rows.where(F.col("depth") % cfg.block_rows == 0)
        full = full.select("conv_id", (F.col("block") + 1).alias("block"),
                           *[F.pmod(F.sum(f"s{i}").over(before), F.lit(_LANE)).alias(f"o{i}") for i in range(3)])
        rows = rows.join(full, ["conv_id", "block"], "left")
        rows = rows.withColumns({f"s{i}": F.pmod(F.col(f"s{i}") + F.coalesce(f"o{i}", F.lit(0)), F.lit(_LANE))
                                 for i in range(3)})
    up = [F.pmod(F.col(f"s{i}") - F.col(f"t{i}"), F.lit(_LANE)) for i in range(3)]

    def packed(lanes: list) -> list:
        high, low = F.expr(f"{1 << 20}L"), F.lit(1 << 20)
        return [lanes[0] * high + F.floor(lanes[2] / low).cast("long"), lanes[1] * high + lanes[2] % low]

    (ka, kb), (pka, pkb) = packed([F.col(f"s{i}") for i in range(3)]), packed(up)
    rows = rows.select("conv_id", "depth", ka.alias("ka"), kb.alias("kb"), pka.alias("pka"), pkb.alias("pkb"), "bytes", "ends")
    return stage(_above(rows, cfg), "paths")


def _exploded(rows: DataFrame, skip: int = 0) -> DataFrame:
    """(depth, ka, kb, leaves, saved) for each of ``above`` but the first ``skip``, deeper ones last."""

    place = F.posexplode("above").alias("i", "up")
    return rows.select("depth", F.size("above").alias("many"), "leaves", "saved", place).where(F.col("i") >= skip).select(
        (F.col("depth") - F.col("many") + F.col("i")).alias("depth"), F.col("up.ka").alias("ka"), F.col("up.kb").alias("kb"),
        "leaves", "saved")


def _added(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEY).agg(F.max("conv_id").alias("conv_id"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _totals(paths: DataFrame, values: DataFrame, deepest: int, cfg: TrieConfig) -> DataFrame:
    """``values`` (depth, ka, kb, conv_id, leaves, saved) summed over subtrees."""

    # a node stands on the path of its smallest member
    own = paths.select("conv_id", "depth", "above").join(values, ["conv_id", "depth"])
    own = stage(own.select(*KEY, "above", "leaves", "saved"), "own") if deepest >= cfg.band else own
    in_band = _exploded(own.where(F.col("depth") % cfg.band != 0)).withColumn("conv_id", F.lit(None).cast("long"))
    inside = _added(values.unionByName(in_band))
    if deepest < cfg.band:
        return inside
    inside = stage(inside, "bands")
    root, rung = F.col("depth") % cfg.band == 0, (F.col("depth") / cfg.band).cast("long")
    top = F.get("above", F.lit(0))
    upper = paths.where(root).select("conv_id", rung.alias("depth"), "ka", "kb", top["ka"].alias("pka"), top["kb"].alias("pkb"))
    roots = inside.where(root).withColumn("depth", rung)
    tops = stage(_totals(_above(upper, cfg), roots, deepest // cfg.band, cfg), "tops")
    tops = tops.withColumn("depth", F.col("depth") * cfg.band)
    passed = own.where(root).drop("leaves", "saved").join(tops.drop("conv_id"), KEY)
    passed = _exploded(passed, skip=1).withColumn("conv_id", F.lit(None).cast("long"))
    return _added(inside.where(~root).unionByName(passed)).unionByName(tops)


def _ends(paths: DataFrame, convs: DataFrame, nodes: DataFrame, hot: int, cfg: TrieConfig) -> DataFrame:
    """(depth, ka, kb, ends_sha256) of the nodes at which conversations end."""

    last = paths.where("ends = 1").select(*KEY, "conv_id").unionByName(convs.where("len = 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("ka"), F.lit(0).cast("long").alias("kb"), "conv_id"))
    many = nodes.where(F.col("n_ends") > hot).select(*KEY)  # at most 10,000 of them
    text = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    few = last.join(F.broadcast(many), KEY, "left_anti").groupBy(*KEY).agg(F.sha2(text, 256).alias("ends_sha256"))
    if many.isEmpty():
        return few
    rows, pieces = placed(last.join(F.broadcast(many), KEY), KEY, ["conv_id"])
    chunk = F.expr(f"(at + shift) div {cfg.chunk_ids}").alias("chunk")
    rows = rows.join(pieces, ["piece", *KEY]).groupBy(*KEY, chunk).agg(text.alias("ids"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One running SHA-256 per node over its chunks in their order: only the open digest is held."""

        key, digest = None, None
        for batch in batches:
            done = []
            for *here, _chunk, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if here != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = here, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=[*KEY, "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, digest.hexdigest())], names=[*KEY, "ends_sha256"])

    ordered = rows.select(*KEY, "chunk", "ids").repartition(*KEY).sortWithinPartitions(*KEY, "chunk")
    schema = "depth long, ka long, kb long, ends_sha256 string"
    return few.unionByName(ordered.mapInArrow(digests, schema))


def prefix_trie(convs: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                branching: Branching | None = None, cfg: TrieConfig | None = None) -> DataFrame:
    """Nodes of the trie: conv_id, depth, parent_conv_id, n_convs, n_ends, n_children, n_leaves, saved_tokens, ends_sha256.

    A node is named by its smallest member and its depth: its last turn is turn
    number ``depth`` of conversation ``conv_id`` (as rebuilt by ``branching``). The
    root has depth 0 and no parent. ``saved_tokens`` sums, over the subtree, the
    bytes of a node's last text for each member but one.

    Turns stand by ``turn``, null first, then by role and a digest of role and
    text; repeated rows are turns of their own. A null role or text is empty;
    rows without a conv_id (an integer) belong to no conversation; an empty
    table has no nodes. Other columns are not read.
    """

    cfg = cfg or TrieConfig()
    rows, pieces = _turns(convs, conv_id, turn, role, text)
    turns, lengths = _rebuilt(rows, pieces, branching)
    total, longest = lengths.agg(F.count(F.lit(1)), F.coalesce(F.max("len"), F.lit(0))).first()
    paths = _paths(turns, longest, cfg)
    found = paths.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("ends").alias("n_ends"),
        F.max("bytes").alias("bytes"), F.max("pka").alias("pka"), F.max("pkb").alias("pkb"))
    zero = F.lit(0).cast("long")
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                       F.coalesce(F.count_if(F.col("len") == 0), zero).alias("n_ends")).where("n_convs > 0")
    root = root.select(*[zero.alias(k) for k in KEY], "conv_id", "n_convs", "n_ends", zero.alias("bytes"),
                       zero.alias("pka"), zero.alias("pkb"))
    nodes = stage(found.unionByName(root), "nodes")

    values = nodes.select(*KEY, "conv_id", (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaves"),
                          ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    totals = _totals(paths, values, longest, cfg)
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pka").alias("ka"),
                                                F.col("pkb").alias("kb")).agg(F.count(F.lit(1)).alias("n_children"))
    ends = _ends(paths, lengths, nodes, max(cfg.chunk_ids, total // 10_000), cfg)
    whole = nodes.join(totals.drop("conv_id"), KEY).join(children, KEY, "left").join(ends, KEY, "left")
    whole = stage(whole.select(
        *KEY, "pka", "pkb", "conv_id", "n_convs", "n_ends", F.coalesce("n_children", zero).alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")), "whole")

    parent = [(F.col("depth") + 1).alias("depth"), F.col("ka").alias("pka"), F.col("kb").alias("pkb")]
    hot = max(cfg.hot_children, whole.count() // 1_000)
    busy = whole.where(F.col("n_children") > hot).select(*parent, F.col("conv_id").alias("busy_id"))  # at most 1,000
    calm = whole.where((F.col("n_children") > 0) & (F.col("n_children") <= hot)).select(
        *parent, F.col("conv_id").alias("parent_conv_id"))
    up = ["depth", "pka", "pkb"]
    whole = stage(whole.join(F.broadcast(busy), up, "left"), "busy") if not busy.isEmpty() else whole.withColumn(
        "busy_id", F.lit(None).cast("long"))
    settled = whole.where("depth = 0 OR busy_id IS NOT NULL").withColumn("parent_conv_id", F.col("busy_id"))
    rest = whole.where("depth > 0 AND busy_id IS NULL").join(calm, up)
    return settled.unionByName(rest).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_ends", "n_children", "n_leaves",
                                            "saved_tokens", "ends_sha256")
