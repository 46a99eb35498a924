import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlane.llm import common, prefix_trie, quality, queries, regular_sort, resampling

SF = "/root/testdata/sf0.01"


def test_ranks_by_regular_sampling_with_one_hot_key(spark):
    rng = random.Random(1)
    rows = [(7 if i % 3 else rng.randint(0, 50), rng.choice([None, "a", "b"]), i) for i in range(3000)]
    df = common.stage(spark.createDataFrame(rows, "k long, s string, segment long").repartition(7), "t")
    got = regular_sort.regular_ranks(df, ["k", "s"], regular_sort.SortConfig(runs=6)).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 3001)) and {(r.k, r.s, r.segment) for r in got} == set(rows)
    keys = [(r.k, r.s is not None, r.s or "") for r in sorted(got, key=lambda r: r["rank"])]
    assert keys == sorted(keys)


def test_segments_hold_at_most_twice_their_share(spark, monkeypatch):
    seen = []
    real = regular_sort.stage
    monkeypatch.setattr(regular_sort, "stage", lambda df, name: seen.append((name, real(df, name))) or seen[-1][1])
    df = common.stage(spark.range(4000).selectExpr("CAST(1 AS long) AS k").repartition(8), "t")
    assert regular_sort.regular_ranks(df, ["k"], regular_sort.SortConfig(runs=8)).agg(F.max("rank")).first()[0] == 4000
    sizes = [r["count"] for r in dict(seen)["segments"].groupBy("segment").count().collect()]
    assert max(sizes) <= 2 * 4000 / 8 + 8 and len(sizes) >= 6


@pytest.mark.parametrize("longest", [1, 2])
def test_resampling_equals_brute_force(spark, longest):
    rng = random.Random(2)
    vocab = ["Alpha", "beta", "été", "x9", "don't", "ß", "ÀB"]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 60))) + rng.choice(["", " zeta!", "\n\tEta"])) for i in range(400)]
    docs += [(1000, None), (1001, ""), (1002, "?!"), (None, "alpha " * 30), (1003, "beta " * 100_000)]
    target = ["alpha zeta", None, "été été x9", ""]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit("clash"), "rank": F.lit(0)})
    t = spark.createDataFrame([(x,) for x in target], "text string")
    cfg = resampling.ResampleConfig(longest=longest)
    got = resampling.importance_resample(d, t, cfg=cfg, sort=regular_sort.SortConfig(runs=4)).collect()
    assert {r["row"].doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in got} == brute.resampled(docs, target, longest=longest)
    assert {r["row"].score for r in got} == {"clash"}
    drawn = resampling.draw(d, t, cfg=cfg)
    assert drawn.columns == d.columns and drawn.count() == sum(r["rank"] is not None for r in got) > 20


def test_resampling_of_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(5, "one two three " * 10)] * 90 + [(i, "four five " * 15) for i in range(10)], "doc_id long, text string")
    none = spark.createDataFrame([], "text string")
    got = resampling.importance_resample(docs, none).collect()
    assert len(got) == 100 and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 11))
    assert resampling.importance_resample(docs.limit(0), none).count() == 0


def test_quality_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    got = queries.op12_quality(spark, SF).join(labels, "doc_id").where("held_out")
    n, right, low, high, off = got.agg(F.count("*"), F.count_if(F.expr("predicted = quality")), F.min("score"), F.max("score"),
                                       F.count_if(F.expr("predicted <> CAST(score >= 0.3D AS int)"))).first()
    assert n > 50 and right / n > 0.95 and 0 <= low < 0.3 < high <= 1 and off == 0


def test_quality_learns_the_preferred_shape_and_scores_odd_rows(spark):
    good = [(i, f"Plain words of a sentence, number {i}.") for i in range(60)]
    bad = [(100 + i, f"BUY!!! NOW### {i} $$$ *** @@@") for i in range(30)]
    odd = [(200, None), (201, ""), (202, "words of a plain sentence. " * 50_000), (203, "###!!! $$$"), (None, "A plain sentence."), (3, good[3][1])]
    docs = spark.createDataFrame(good + bad + odd, "doc_id long, text string").withColumns({"score": F.lit("clash"), "better": F.lit(1)})
    labels = [(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(200, None), (None, 1), (1, 1), (203, 7)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("text", F.lit("clash"))
    rated = quality.rate(docs, labels)
    got = rated.select("row.doc_id", "score", "predicted").collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 96 and all(by[i].predicted == 1 for i, _ in good) and all(by[i].predicted == 0 for i, _ in bad)
    assert by[203].predicted == 0 and by[None].predicted == 1 and by[200].score == by[201].score and 0 <= by[200].score <= 1
    assert quality.keep_good(docs, labels).columns == docs.columns
    # held-out labels change nothing
    held = [r.doc_id for r in rated.where("held_out").select("row.doc_id").collect()]
    turned = labels.withColumn("quality", F.when(F.col("doc_id").isin(held), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.rate(docs, turned).select("row.doc_id", "score").collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score, abs=1e-9) for r in got)


def test_quality_without_anything_to_compare(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    for rows in ([], [(1, 1), (2, 1)], [(1, 1), (77, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        assert {(r.score, r.predicted) for r in quality.rate(docs, labels).collect()} == {(0.3, 1)}
    assert quality.rate(docs.limit(0), labels).count() == 0


def test_quality_learns_from_every_labelled_document(spark):
    texts = [f"Line {i} of many, {'plain words ' * (i % 13)}{'!#' * (i % 7)}" for i in range(8_700)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    labels = docs.select("doc_id", (F.col("doc_id") % 29 > 0).cast("int").alias("quality"))
    model = quality.train(docs, labels, cfg=quality.QualityConfig(pairs=10, steps=5))
    x = np.stack([quality.features(t) for t in texts])
    assert model.mean == pytest.approx(x.mean(axis=0)) and model.scale == pytest.approx(x.std(axis=0, ddof=1) + 1e-6)
    assert np.count_nonzero(model.raw(x) < model.cut) == 300  # as many as are labelled 0
    shapes = quality._vectors(docs.select(F.col("doc_id").alias("id"), "text"))
    vectors = shapes.join(labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("better")), "id").select("id", "better", "x")
    pairs = quality._gaps(vectors, model, {0: 300, 1: 8_400})
    assert pairs.count() == 8_400


def test_quality_weights_minimise_the_pairwise_loss():
    rng = np.random.default_rng(3)
    assert quality.features("").shape == (quality.N_FEATURES,) == quality.features("É x\x00\x7f" * 9).shape
    x = quality.features("".join(map(chr, rng.integers(1, 500, 4000))))
    assert np.isfinite(x).all() and x[11 : 11 + quality._N].sum() == pytest.approx(1)


def _nodes(df):
    return {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
            for r in df.collect()}


@pytest.mark.parametrize("cfg", [None, prefix_trie.TrieConfig(band=2, block_rows=4, hot_children=2, chunk_ids=3)])
def test_trie_equals_brute_force(spark, cfg):
    rng = random.Random(4)
    said = ["Hi", "Été", "", "ok then"]
    convs = []
    for c in [*range(0, 40), 60, 61, 63, 77, -3, -5]:
        n = rng.randint(1, 12) if c != 7 else 45  # one long conversation, cut into blocks and bands
        convs += [(c, t if t or c % 2 else None, rng.choice(["user", "bot"])[: rng.randint(3, 4)], rng.choice(said[: 1 + (t > 0) * 3]))
                  for t in range(n)]
    convs += [(200 + i, t, "user", "same") for i in range(20) for t in range(3)]  # copies
    convs += [(400, 0, None, None), (401, 0, "", ""), (None, 0, "user", "nobody"), (13, 99, "bot", "long " * 100_000)]
    rng.shuffle(convs)
    df = spark.createDataFrame(convs, "conv_id long, turn long, role string, text string").withColumns(
        {"depth": F.lit("clash"), "ka": F.lit(1), "n": F.lit("x")})
    got = prefix_trie.prefix_trie(df, branching=prefix_trie.Branching(), cfg=cfg)
    assert _nodes(got) == brute.trie(convs)
    assert got.count() == len(brute.trie(convs))
    assert _nodes(prefix_trie.prefix_trie(df, cfg=cfg)) == brute.trie(convs, branching=False)


def test_trie_of_ties_repeated_rows_and_empty_tables(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "bot", "z"), (6, 0, "bot", "z"), (6, 1, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = _nodes(prefix_trie.prefix_trie(df))
    # equal turns stand by role: bot z, user a, user a
    assert sorted(got) == [(1, 0), (1, 1), (1, 2), (1, 3)] and got[1, 2][1] == 2 and got[1, 3][1] == 1
    assert prefix_trie.prefix_trie(df.limit(0)).count() == 0
    assert prefix_trie.prefix_trie(df.limit(0), branching=prefix_trie.Branching()).count() == 0


def test_turnless_conversations_end_at_the_root(spark):
    # without its lender, a conversation no longer than the turns it would borrow has none
    import zlib

    c = next(i for i in range(1, 1000) if i % 5 and zlib.crc32(str(i).encode()) % 9 >= 2)
    df = spark.createDataFrame([(c, 0, "user", "a"), (c, 1, "bot", "b")], "conv_id long, turn long, role string, text string")
    want = brute.trie([(c, 0, "user", "a"), (c, 1, "bot", "b")])
    assert _nodes(prefix_trie.prefix_trie(df, branching=prefix_trie.Branching())) == want and list(want) == [(c, 0)]
