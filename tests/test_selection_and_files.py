import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattlane.errors import DataValidationError
from wattlane.operators import selection
from wattlane.operators.selection import keys_at
from wattlane.operators.splits import train_test_split, train_validation_test_split
from wattlane.operators.validate import (
    read_csv_text, read_export_csv, read_panel_csv, too_long, validation_report, write_validated,
)

HEAD = "timestamp,zone,load_mw,temperature_c,wind_speed_mps,solar_radiation_wm2"


def keyed(spark, n, seed=1):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(hours=i // 7) if i % 11 else None, f"z{i:05d}", float(i)) for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, zone string, load_mw double"), sorted(
        rows, key=lambda r: (r[0] is not None, r[0] or start, r[1]))


@pytest.mark.parametrize(("candidates", "sample"), [(1 << 17, 1 << 15), (100, 500)])
def test_keys_at_ranks(spark, candidates, sample):
    df, rows = keyed(spark, 3000)
    ranks = [0, 1, 299, 1500, 2998, 2999]
    cuts = keys_at(df, ["timestamp", "zone"], ranks, 3000, candidates=candidates, sample=sample).first()
    assert [tuple(cuts[f"cut{i}"]) for i in range(len(ranks))] == [rows[r][:2] for r in ranks]


def test_no_key_separates_equal_rows(spark):
    df = spark.createDataFrame([(i // 500, "a") for i in range(2000)], "timestamp int, zone string")
    for candidates in (1 << 17, 100):
        assert keys_at(df, ["timestamp", "zone"], [700], 2000, candidates=candidates, sample=100) is None
    assert keys_at(df, ["timestamp", "zone"], [1000], 2000).first()["cut0"]["timestamp"] == 2


def test_splits_by_selection_equal_numbered_ones(spark, monkeypatch):
    df, _ = keyed(spark, 1500)
    monkeypatch.setitem(keys_at.__kwdefaults__, "candidates", 100)
    monkeypatch.setitem(keys_at.__kwdefaults__, "sample", 400)
    pairs = [
        [train_test_split(df, 0.2, purge=10, numbered=n) for n in (True, False)],
        [train_test_split(df, 0.3, split_method="random", numbered=n) for n in (True, False)],
        [train_validation_test_split(df, validation_size=0.25, test_size=0.1, numbered=n) for n in (True, False)],
    ]
    for with_rn, without in pairs:
        assert with_rn.counts == without.counts and "rn" in with_rn.frame.columns
        assert sorted(without.frame.columns) == sorted([*df.columns, "split"])
        named = lambda s: sorted((r.zone, r.split) for r in s.frame.collect())
        assert named(with_rn) == named(without)
        plan = without.frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange rangepartitioning" not in plan and "Exchange hashpartitioning" not in plan


def test_splits_between_equal_keys_keep_their_counts(spark):
    df = spark.createDataFrame([(1, "a", float(i)) for i in range(40)], "timestamp int, zone string, load_mw double")
    s = train_test_split(df, 0.25, numbered=False)
    assert s.part("train").count() == 30 and s.part("test").count() == 10 and "rn" not in s.frame.columns
    assert selection.keys_at(df, ["load_mw"], [5], 40).first()["cut0"]["load_mw"] == 5.0


def csv(path, *lines):
    path.write_text("\n".join([HEAD, *lines]) + "\n")
    return str(path)


def test_csv_rows_with_too_many_fields_are_refused(spark, tmp_path):
    path = csv(tmp_path / "a.csv", "2026-01-01,n,1,2,3,4", "2026-01-02,n,1,2,3,4,5,6")
    with pytest.raises(DataValidationError, match="more fields than the header"):
        read_panel_csv(spark, path)
    with pytest.raises(DataValidationError, match="more fields than the header"):
        read_export_csv(spark, path)
    trailing = csv(tmp_path / "b.csv", "2026-01-01,n,1,2,3,4,")
    with pytest.raises(DataValidationError, match="more fields than the header"):
        read_export_csv(spark, trailing)
    wide = tmp_path / "wide.csv"
    wide.write_text(f"{HEAD},note\n2026-01-01,n,1,2,3,4,x\n2026-01-02,n,1,2,3,4,x,y\n")  # a column that no rule reads
    with pytest.raises(DataValidationError, match="more fields than the header"):
        read_panel_csv(spark, str(wide))
    with pytest.raises(FileNotFoundError):
        read_panel_csv(spark, str(tmp_path / "none.csv"))


def test_csv_rows_short_of_fields_have_missing_values(spark, tmp_path):
    path = csv(tmp_path / "a.csv", '2026-01-01,"a,b",1,2,3,4', "2026-01-02,n,1")
    rows = read_export_csv(spark, path).collect()
    assert (rows[0].zone, rows[1].temperature_c, rows[1].solar_radiation_wm2) == ("a,b", None, None)
    df = read_csv_text(spark, path)
    assert [r.long for r in df.select("*", too_long(df).alias("long")).collect()] == [False, False]
    with pytest.raises(DataValidationError, match="missing or non-numeric"):
        read_panel_csv(spark, path)


def test_csv_quotes_and_line_breaks(spark, tmp_path):
    path = csv(tmp_path / "a.csv", '2026-01-01,"say ""B""",1,2,3,4', '2026-01-02,"two\nlines, ""q""",1,2,3,4')
    assert [r.zone for r in read_panel_csv(spark, path).collect()] == ['say "B"', 'two\nlines, "q"']


def panel(spark, *rows):
    return spark.createDataFrame([tuple(r.split(",")) for r in rows], ", ".join(f"{c} string" for c in HEAD.split(",")))


def test_validation_report_is_one_scan(spark, tmp_path):
    panel(spark, "2026-01-01,n,1,2,3,4", "x,n,1,2,3,4", "x,n,1,2,3,4", "2026-01-01,n,1,2,3,z").write.parquet(str(tmp_path / "p"))
    report = validation_report(spark.read.parquet(str(tmp_path / "p")))
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r.rule: r.violations for r in report.collect()} == {
        "empty_input": 0, "timestamp_unparsable": 2, "missing_or_non_numeric": 1, "blank_zone": 0, "duplicate_keys": 2}


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_broken_rule_leaves_the_target_as_it_was(spark, tmp_path, fmt):
    path = str(tmp_path / "out")
    good = panel(spark, "2026-01-01 00:00:00.123456,n,1,2,3,4", "2026-01-02,n, 5 ,2,3,4")
    assert sorted(r.load_mw for r in write_validated(good, path, fmt=fmt).collect()) == [1.0, 5.0]
    for bad, message in ((panel(spark, "2026-01-01,n,1,2,3,4", "x,n,1,2,3,4"), "timestamp"),
                         (panel(spark, "2026-01-01,n,1,2,3,"), "missing or non-numeric"),
                         (panel(spark, "2026-01-01, ,1,2,3,4"), "Zone"), (good.limit(0), "empty"),
                         (good.union(good), "Duplicate records")):
        with pytest.raises(DataValidationError, match=message):
            write_validated(bad, path, fmt=fmt)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out"]
    back = write_validated(good.where(F.col("load_mw") == "1"), path, fmt=fmt)
    assert [(r.load_mw, r.timestamp.microsecond) for r in back.collect()] == [(1.0, 123456)]


def test_injected_events_compose_in_draw_order(spark):
    import numpy as np

    from wattlane.operators.inject import SHIFT_ROWS, inject_anomalies

    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(hours=i), z, 500.0 + i) for z in ("a", "b") for i in range(150)]
    df = spark.createDataFrame(rows, "timestamp timestamp_ntz, zone string, load_mw double").withColumn("is_anomaly", F.lit("clash"))
    got = {(r.zone, r.timestamp): r for r in inject_anomalies(df, 0.2, seed=7, floor=100.0).collect()}
    assert len(got) == 300

    def digest(zone, ts):
        import hashlib

        micros = (ts - datetime(1970, 1, 1)) // timedelta(microseconds=1)
        return hashlib.md5(f"7:{zone}:{micros}".encode()).hexdigest()

    loads = {(z, t): v for t, z, v in rows}
    kinds = {}
    for key, (zone, ts) in sorted((digest(z, t), (z, t)) for t, z, _ in rows)[:60]:  # one event after the other
        kind = ("spike", "drop", "level_shift")[int(key[8:16], 16) % 3]
        u = int(key[16:24], 16) / 2**32
        for i in range(SHIFT_ROWS if kind == "level_shift" else 1):
            at = zone, ts + timedelta(hours=i)
            if at in loads:
                if kind == "level_shift":
                    loads[at] += (1 if int(key[24:32], 16) % 2 == 0 else -1) * (90 + 70 * u)
                else:
                    loads[at] *= 1.35 + 0.45 * u if kind == "spike" else 0.45 + 0.25 * u
                kinds[at] = kind
    for at, r in got.items():
        assert (r.is_anomaly, r.anomaly_type) == (at in kinds, kinds.get(at, "normal"))
        assert abs(r.load_mw - np.round(max(loads[at], 100.0), 3)) < 2e-3
    assert inject_anomalies(df, 0.0, rows=300).where("is_anomaly").count() >= 1
    assert inject_anomalies(df.limit(3), 0.99).where("is_anomaly").count() == 3
