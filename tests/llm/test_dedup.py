import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from wattlane.llm import graph, line_dedup, minhash, vectors


def _variants():
    """Copies, near copies around the threshold, chains, one large group and a passage that many share."""

    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    rows = [None, "", " \t\n", "one two", "ONE  two", "two one"]
    for n in (30, 80, 200):
        base = text(n).split()
        for edits in range(0, 8):
            copy = list(base)
            for _ in range(edits):
                copy[rng.randrange(n)] = rng.choice(vocab)
            rows.append(" ".join(copy))
        chain = list(base)
        for _ in range(12):
            chain = chain[4:] + text(4).split()
            rows.append(" ".join(chain))
    group = text(120).split()
    for _ in range(150):
        copy = list(group)
        copy[rng.randrange(120)] = rng.choice(vocab)
        rows.append(" ".join(copy))
    passage = text(60)
    rows += [f"{text(rng.randint(20, 120))} {passage} {text(30)}" for _ in range(80)]
    rows += [text(100).upper() for _ in range(20)] + [text(6000)] * 2 + ["same text " * 9] * 40
    return rows


def test_near_duplicates_equal_brute_force(spark):
    rows = list(enumerate(_variants()))
    random.Random(2).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rep", F.lit("clash")).withColumn("n", F.lit(0))
    cfg = minhash.MinHashConfig(block=8)  # small blocks: the block pairs are taken, too
    for c in (None, cfg):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, cfg=c).collect()}
        assert got == brute.near(rows)


def test_near_duplicates_of_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, text), (5, text), (7, text), (None, text), (9, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()), key=str)
    assert got == [(2, 0, 2, True), (5, 26, 5, True), (5, 26, 5, True), (7, 26, 5, False), (9, 0, 9, True),
                   (None, 26, None, True)]
    kept = minhash.drop_near_duplicates(docs.withColumn("gone", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "gone"]
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2, 5, 9]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_signature_is_circulant_and_estimates_jaccard():
    cfg = minhash.MinHashConfig()
    first, shifted = minhash._permutations(cfg)
    assert sorted(first[:1000].tolist()) != first[:1000].tolist()
    assert (shifted[5, :-1] == shifted[4, 1:]).all()  # the next row is the shift by one
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[500:2500])
    same = (minhash.signature(a, cfg) == minhash.signature(b, cfg)).mean()
    assert abs(same - 1500 / 2500) < 0.12


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 90)] + [(95, 95), (None, 3), (92, 91), (91, 92)]
    got = dict(graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 90)} | {91: 91, 92: 91}
    assert got == want
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def _vector_rows():
    rng = np.random.default_rng(4)
    rows = []
    for c in rng.normal(size=(6, 12)):
        rows += [(c + rng.normal(size=12) * s).tolist() for s in np.linspace(0, 0.8, 25)]
    hot = rng.normal(size=12)
    rows += [(hot + rng.normal(size=12) * 0.02).tolist() for _ in range(120)] + [hot.tolist()] * 30 + [(2 * hot).tolist()]
    rows += [None, [], [0.0] * 12, [float("nan")] * 12, [1.0, None] * 6, [float("inf")] * 12, [1.0, 2.0], [2.0, 4.0]]
    return list(enumerate(rows))


@pytest.mark.parametrize("cfg", [None, vectors.VectorConfig(tile_rows=32, strip_rows=8)])
def test_near_vectors_equal_brute_force(spark, cfg):
    rows = _vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit("clash")).withColumn(
        "node", F.lit(0))
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(df, cfg=cfg).collect()}
    assert got == brute.vectors(rows)


def test_near_vectors_of_odd_rows(spark):
    one, two = [1.0, 0.0], [0.0, 1.0]
    df = spark.createDataFrame([(4, one), (4, two), (9, one), (None, two), (6, None)], "vec_id long, embedding array<float>")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df).collect()), key=str)
    assert got == [(4, 1, 4, True), (4, 1, 4, True), (6, 0, 6, True), (9, 1, 4, False), (None, 1, None, True)]
    far = spark.createDataFrame([(1, [1e200, 1e200]), (2, [1e-200, 1e-200]), (3, [1e200, 0.0])], "vec_id long, embedding array<double>")
    assert {r.vec_id: r.component_id for r in vectors.near_vectors(far).collect()} == {1: 1, 2: 1, 3: 3}
    assert vectors.near_vectors(df.limit(0)).count() == 0
    assert vectors.near_vectors(df.where("embedding is null")).count() == 1


def test_line_dedup(spark):
    menu, foot = "Home | About ", "© shared"
    rows = [(i, "a", f"{menu}\nbody {i}\n\n{foot if i % 2 else ''}") for i in range(20)]
    rows += [(100 + i, None, f"\t{menu.strip()}\r\nown {i}") for i in range(3)] + [(200, "a", None), (201, "b", menu), (202, "a", "")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("site", F.lit("clash")).withColumn(
        "n_chars", F.length("text").cast("long"))
    got = {r["row"].doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert len(got) == len(rows)
    assert got[0].text == "body 0\n\n" and (got[0].n_lines, got[0].n_dropped) == (4, 1)
    assert got[1].text == "body 1\n" and got[1].n_dropped == 2
    assert got[101].text == "own 1"  # blanks around a line don't matter; null is a site
    assert got[200].text is None and got[200].n_lines == 0
    assert got[201].text == menu  # one page is no evidence
    assert got[202].text == "" and got[202].n_lines == 1
    out = line_dedup.drop_boilerplate(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.n_chars for r in out.collect()}[0] == len("body 0\n\n")
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_line_dedup_counts_a_line_once_a_page(spark):
    rows = [(i, "s", "x\n" * (50 if i == 0 else 0) + f"body {i}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert {r.n_dropped for r in line_dedup.dedup_lines(docs).collect()} == {0}


def test_pipeline_drops_lines_of_a_few_hundredths_of_a_site(spark):
    import corpus_pipeline

    rows = [(i, "s", f"body {i}" + ("\nmenu" if i < 12 else "") + ("\nrefrain" if i >= 297 else "")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert got == {i: t.replace("\nmenu", "") for i, _, t in rows}  # on 4 %: goes; on 1 %: stays
