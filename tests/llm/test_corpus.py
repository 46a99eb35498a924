import gzip
import hashlib
import random

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wattlane.llm import decontam, langid, licenses, mixing, queries, warc

SMOKE = "/root/testdata/sf0.001"


def test_contamination_equals_brute_force(spark):
    rng = random.Random(6)
    vocab = ["alpha", "Beta", "été", "x9", "don't", "ß"]
    text = lambda n: " ".join(rng.choices(vocab, k=n))
    items = [(i, text(rng.randint(9, 14))) for i in range(30)] + [(50, "alpha"), (51, ""), (52, None), (53, "?!"), (3, text(12))]
    docs = [(i, f"{text(rng.randint(0, 30))}, {rng.choice(items)[1] or ''}!! {text(8)}".replace(" ", rng.choice([" ", "  \n"])))
            for i in range(60)] + [(100, None), (101, ""), (102, "...")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("whole", F.lit(1)).withColumn("items", F.lit("clash"))
    b = spark.createDataFrame(items * 2, "item_id long, text string")
    want = brute.contamination(docs, items)
    for cfg in (None, decontam.DecontamConfig(automaton_chars=700)):  # one automaton, and several shards
        got = {r["row"].doc_id: r for r in decontam.contamination(d, b, cfg=cfg).collect()}
        assert {k: (r.n_words, r.n_hit, r["items"]) for k, r in got.items()} == want
        assert all(r.contaminated == (want[k][1] > 0) for k, r in got.items())


def test_contamination_offsets_and_empty_tables(spark):
    item = "one two three four five six seven eight nine ten"
    text = "É — (Intro) " + item.upper().replace(" ", ", ") + ". End"
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    b = spark.createDataFrame([(7, item)], "item_id long, text string")
    (r,) = decontam.contamination(d, b).collect()
    (s,) = r.spans
    assert text[s.start : s.end] == item.upper().replace(" ", ", ") and r.n_hit == 10
    assert decontam.drop_contaminated(d, b).count() == 0
    assert decontam.drop_contaminated(d, b.limit(0)).columns == d.columns
    assert decontam.drop_contaminated(d, b.limit(0)).count() == 1
    assert decontam.contamination(d.limit(0), b).count() == 0


def test_language_id_held_out_accuracy(spark):
    got = queries.op8_language_id(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    right, n, low, high = got.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*"), F.min("score"), F.max("score")).first()
    assert n > 200 and right / n > 0.98 and 0 <= low <= high <= 1


def test_language_id_of_odd_rows(spark):
    import zlib

    rows = [(i, "the cat and the dog in the house " * 3, "en") for i in range(20)]
    rows += [(100 + i, "der hund und die katze in dem haus " * 3, "de") for i in range(20)]
    rows += [(200, None, "en"), (201, "12 %% !!", "de"), (202, "", None), (203, "und der hund", None), (None, "the dog", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = {r["row"].doc_id: r for r in langid.identify(docs).collect()}
    assert [got[k].lang_pred for k in (0, 100, 200, 201, 202, 203, None)] == ["en", "de", "und", "und", "und", "de", "en"]
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in got.items() if k is not None)
    assert {r.doc_id for r in langid.keep_identified(docs).collect()} >= {0, 100, 203}
    assert not {200, 201, 202} & {r.doc_id for r in langid.keep_identified(docs).collect()}
    nothing = langid.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert langid.identify(docs.limit(0)).count() == 0
    one = langid.identify(docs.where("lang = 'en' and text is not null"))
    assert {r.lang_pred for r in one.collect()} == {"en"}


def test_codewords_differ_by_half_of_their_bits():
    for n in (2, 3, 4, 5, 9, 30):
        code = langid.codewords(n, 1)
        apart = min((code[a] != code[b]).sum() for a in range(n) for b in range(a))
        assert apart >= max(1, code.shape[1] // 4)


def _mix(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("rank", F.lit("clash"))
    return mixing.mix_sources(docs).collect()


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(8)
    sizes = {"a": 900, "b": 400, "c": 60, None: 200}
    rows = [(i, s, "w " * rng.randint(1, 9)) for s, n in sizes.items() for i in range(n)]
    got = _mix(spark, rows)
    assert len(got) == len(rows)
    total = sum(r["size"] for r in got)
    targets = {r.source_size: r.target for r in got}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    assert all(t <= 2 * s + 1e-6 for s, t in targets.items())
    for s, t in targets.items():
        assert abs(sum(r.taken for r in got if r.source_size == s) - t) <= 12
    assert all(r.taken in (0, r["size"], 2 * r["size"]) for r in got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, _mix(spark, rows[::-1])))  # reruns agree


def test_mix_of_odd_rows(spark):
    assert _mix(spark, []) == []
    got = _mix(spark, [(1, "a", None), (2, "b", ""), (None, None, " ")])
    assert [(r["size"], r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 3
    (r,) = _mix(spark, [(1, None, "w " * 10)])
    assert (r.source_size, r.target, r.taken) == (10, 15.0, 10)
    twice = _mix(spark, [(1, "a", "w w")] * 4 + [(2, "a", "w")])
    assert len(twice) == 5 and sum(r.taken for r in twice) in (12, 13)


def test_warc_round_trip(spark, tmp_path):
    big = "é" * 600
    rows = [(1, "http://a/1", big), (2, None, big), (3, "http://a/3\r\nX: y", "small"), (4, "u", "small"), (5, "u", None),
            (6, "u", ""), (2, "u", big), (None, "u", big), (8, "u", "WARC/1.1\r\n\r\n" * 200), (9, "u", "x" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    path = str(tmp_path / "w")
    warc.write_warc(pages, path)
    got = warc.read_warc(spark, path)
    assert got.where("type = 'gap'").count() == 0
    out = got.select(warc.page_number("record_id").alias("id"), "type", warc.page_number("refers_to").alias("to"),
                     "payload_bytes", "digest", "payload").collect()
    want = sorted(((i, (h or "").encode()) for i, _, h in rows), key=str)
    assert sorted(((r.id, len(p), hashlib.sha1(p).hexdigest()) for (r, p) in zip(
        sorted(out, key=lambda r: (str(r.id), r.payload_bytes)), sorted((p for _, p in want), key=len))), key=str)
    for r in out:
        full = next((h or "").encode() for i, _, h in rows if i == r.id)
        assert (r.payload_bytes, r.digest) == (len(full), hashlib.sha1(full).hexdigest())
        revisit = r.id in (1, None)
        assert (r.type, r.to) == (("revisit", 2) if revisit else ("response", None))
        assert revisit or bytes(r.payload) == full
    empty = str(tmp_path / "empty")
    warc.write_warc(pages.limit(0), empty)
    assert warc.read_warc(spark, empty).count() == 0


def _archive(n, compress):
    out = []
    for i in range(n):
        payload = f"<p>page {i}</p>".encode() * 20
        r = warc.record_bytes(i, f"http://x/{i}", payload, hashlib.sha1(payload).hexdigest(), None, warc.WarcConfig())
        out.append(gzip.compress(r, mtime=0) if compress else r)
    return out


@pytest.mark.parametrize("compress", [True, False])
def test_salvage_recovers_all_undamaged_records(compress):
    parts = _archive(12, compress)
    middle = len(parts[4]) // 2
    parts[4] = parts[4][:middle] + b"\x00\xff\x00" + parts[4][middle + 3 :]  # damaged
    parts[7] = parts[7][: len(parts[7]) // 3]  # cut off
    parts.insert(2, b"garbage WARC/1.0 \x1f\x8b\x08 junk\n")  # false starts
    data = b"".join(parts) + b"\x1f\x8b"
    rows = list(warc.salvage(data))
    ids = [r["record_id"] for r in rows if r["type"] != "gap"]
    assert ids == [f"<urn:page:{i}>" for i in range(12) if i not in (4, 7)]
    gaps = [(r["offset"], r["length"]) for r in rows if r["type"] == "gap"]
    assert len(gaps) == 4 and all(r["reason"] for r in rows if r["type"] == "gap")
    assert sum(r["length"] for r in rows) == len(data)  # every byte is a record's or a gap's


def _salvaged(data):
    rows = list(warc.salvage(data))
    return [int(r["record_id"][10:-1]) for r in rows if r["type"] != "gap"], [r["reason"] for r in rows if r["type"] == "gap"]


def test_salvage_searches_inside_a_member():
    plain = _archive(12, False)
    bad = [*plain[:3], plain[3].replace(b"page 3", b"page X"), *plain[4:7], b"\r\n", *plain[7:]]
    ids, gaps = _salvaged(gzip.compress(b"".join(bad), mtime=0))
    assert ids == [0, 1, 2, *range(4, 12)] and len(gaps) == 2
    assert f"bytes {len(b''.join(plain[:3]))} to" in gaps[0]
    whole = gzip.compress(b"".join(plain), mtime=0)
    after = _archive(13, True)[12]
    ids, gaps = _salvaged(whole[:-8] + b"\0\0\0\0" + whole[-4:] + after)  # bad CRC, then a good member
    assert ids == [*range(13)] and len(gaps) == 1 and "incorrect data check" in gaps[0]
    ids, gaps = _salvaged(gzip.compress(b"".join(plain), 0, mtime=0)[: -len(plain[11]) // 2])
    assert ids == [*range(11)] and len(gaps) == 2  # cut off inside the last record
    assert _salvaged(gzip.compress(b"no record", mtime=0)) == ([], ["no version line"])


def test_salvage_checks_digests_it_recognises_and_no_others():
    import base64

    def record(i, label, value, field="Block"):
        block = b"HTTP/1.1 200 OK\r\n\r\n" + b"page %d" % i
        h = hashlib.new(label, block if field == "Block" else block[19:]) if label in hashlib.algorithms_available else None
        return (f"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Type: application/http\r\n"
                f"WARC-{field}-Digest: {label}:{value(h)}\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"

    hexed, b32 = lambda h: h.hexdigest(), lambda h: base64.b32encode(h.digest()).decode()
    b64 = lambda h: base64.b64encode(h.digest()).decode()
    good = [record(i, name, value, field) for i, (name, value, field) in enumerate(
        (n, v, f) for n in ("md5", "sha1", "sha256", "sha512") for v in (hexed, lambda h: h.hexdigest().upper(), b32, b64,
                                                                          lambda h: b32(h).rstrip("=")) for f in ("Block", "Payload"))]
    good += [record(len(good), "blake9", lambda h: "abc"), record(len(good) + 1, "sha1", lambda h: "?", "Payload")]
    assert _salvaged(b"".join(good)) == ([*range(len(good))], [])
    for i, r in enumerate(good[:-2]):
        assert _salvaged(r.replace(b"page %d\r" % i, b"pagE %d\r" % i))[0] == []


def test_licences_found_and_clean_documents_left_alone(spark):
    notices = {"mit": "Released under the MIT License.", "apache": "Licensed under the Apache License, Version 2.0.",
               "gpl": "This work is licensed under the GNU General Public License, version 3.", "cc-by-nc": "Licensed under CC BY-NC 4.0.",
               "proprietary": "All rights reserved."}
    clean = spark.read.parquet(f"{SMOKE}/documents.parquet").where("not text rlike '(?i)licen|rights reserved'")
    planted = [(1000 + i, f"Über prose.\n{t}\nmore prose") for i, t in enumerate(notices.values())]
    odd = [(2000, None), (2001, ""), (2002, " \n\t\n"), (None, "x " * 20_000)]
    docs = clean.select("doc_id", "text").union(spark.createDataFrame(planted + odd, "doc_id long, text string"))
    docs = docs.withColumn("spans", F.lit("clash"))
    got = {r["row"].doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert len(got) == docs.count()
    for i, (family, t) in enumerate(notices.items()):
        (s,) = got[1000 + i].spans
        assert (s.family, planted[i][1][s.start : s.end]) == (family, t)
    assert not any(r.spans for k, r in got.items() if k is None or not 1000 <= k < 2000)
    assert (got[2000].n_paragraphs, got[2002].n_paragraphs) == (0, 0)
    alone = licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string"))
    assert alone.count() == 0


def test_licences_by_body_paragraphs_and_other_wordings(spark):
    cases = [
        ("mit", 'The software is provided "as is", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for any purpose and noninfringement.'),
        ("mit", "The above copyright notice and this permission notice must be included in all copies or substantial portions of Foo."),
        ("mit", "Foo is licensed under the terms of the MIT license."),
        ("bsd", "* Redistributions of source code must retain the above copyright notice, these conditions and the following disclaimer."),
        ("bsd", "Neither the name of Example Inc. nor the names of its contributors may be used to endorse or promote products derived from this software without prior written permission."),
        ("apache", "2. Grant of Copyright License. Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual,"),
        ("apache", "(b) You must make any modified files carry prominent notices stating that You have changed the files; and"),
        ("gpl", "You may convey verbatim copies of the Program's source code as you receive it, in any medium,"),
        ("mpl", "Covered Software is provided under this License on an as is basis, without warranty of any kind,"),
        ("cc", "Moral rights, such as the right of integrity, are not licensed under this Public License, nor are publicity, privacy, and/or other similar personality rights;"),
        ("cc-by-nc", "NonCommercial means not primarily intended for or directed towards commercial advantage or money."),
        ("isc", "Permission to use, copy, modify and distribute this software for any purpose with or without fee is hereby granted,"),
        ("zlib", "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original."),
        ("boost", "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom"),
        ("epl", "Each Contributor hereby grants Recipient a non-exclusive, worldwide, royalty-free copyright license to reproduce, prepare Derivative Works of,"),
        (None, "The software of the company was sold to the public in the following year, and the terms of the sale were not published."),
        (None, "You may use the library on any day of the week, but the rooms must not be left open."),
        (None, "of the work"),
    ]
    known = {t for _, t, _ in licenses._ALL}
    assert not known & {t for _, t in cases}
    clean = spark.read.parquet(f"{SMOKE}/documents.parquet").where("not text rlike '(?i)licen|rights reserved'").select("doc_id", "text")
    docs = clean.union(spark.createDataFrame([(1000 + i, t) for i, (_, t) in enumerate(cases)], clean.schema))
    got = {r["row"].doc_id: [s.family for s in r.spans] for r in licenses.scan_licenses(docs).collect()}
    assert {t: got[1000 + i] for i, (_, t) in enumerate(cases)} == {t: [f] if f else [] for f, t in cases}
    assert not any(v for k, v in got.items() if k < 1000)


def test_pipeline_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    rows = docs.collect()
    junk = [(10_001, "123 456", "en", "src1", 7), (10_002, None, None, None, None), (10_003, rows[0].text, "en", "src2", 1)]
    docs = docs.union(spark.createDataFrame(junk, docs.schema))
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMOKE}/benchmark.parquet").collect()]
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language_id", "line_dedup", "near_dedup", "decontaminate", "mix"]

    one = steps["language_id"](spark, docs, SMOKE)
    assert one.columns == docs.columns
    kept = {r.doc_id for r in one.collect()}
    assert not {10_001, 10_002} & kept and len(kept) >= 0.99 * len(rows)
    two = steps["line_dedup"](spark, one, SMOKE).cache()
    assert two.columns == docs.columns and two.count() == len(kept)
    three = steps["near_dedup"](spark, two, SMOKE).cache()
    want = brute.near([(r.doc_id, r.text) for r in two.collect()])
    assert {r.doc_id for r in three.collect()} == {d for d, (_, c) in want.items() if d == c}
    four = steps["decontaminate"](spark, three, SMOKE).cache()
    hit = brute.contamination([(r.doc_id, r.text) for r in three.collect()], bench)
    assert {r.doc_id for r in four.collect()} == {d for d, x in hit.items() if not x[1]}
    five = steps["mix"](spark, four, SMOKE)
    assert five.count() == four.count() and five.columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_registered_queries_match_their_sql(spark):
    import duckdb

    from wattlane.llm.oracle import ORACLES

    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    for name, sql in ORACLES.items():
        got = queries.QUERIES[name](spark, SMOKE)
        cols = sorted(got.columns)
        a = sorted(repr(tuple(r[c] for c in cols)) for r in got.collect())
        b = con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
        assert a == sorted(map(repr, b)), name


def test_every_operator_has_one_query():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert numbers == list(range(1, 11))
