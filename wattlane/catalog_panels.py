"""Registered queries over panels with missing values, CSV files and written tables, with their DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlane.functions.missing import known
from wattlane.operators import detectors as det
from wattlane.operators.features import (
    FeatureConfig, add_lag_features, add_rolling_features, build_feature_frame, build_supervised_frame,
)
from wattlane.operators.splits import train_test_split, train_validation_test_split
from wattlane.operators.validate import LINE, csv_timestamps, quarantine, read_panel_csv, write_validated
from wattlane.schema import CANONICAL_COLUMNS, TARGET
from wattlane.session import ensure_checkpoint_dir
from wattlane.sources.adapters import events_panel, read_table


def _round(c: str) -> Column:
    x = F.col(c)
    return F.round(x + (F.abs(x) * F.lit(1e-12) + F.lit(1e-9)), 6).alias(c)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared checkpoint folder."""

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- NaN is missing


def _gappy(spark: SparkSession, sf: str) -> DataFrame:
    """The event panel with NaN loads (and infinite ones, which count for lags alone), and NULL and NaN temperatures."""

    solar = F.col("solar_radiation_wm2")
    load = F.when(solar % 13 == 5, F.lit(float("nan"))).when(solar % 211 == 7, F.lit(float("inf"))).otherwise(F.col("load_mw"))
    warm = F.when(solar % 17 == 3, F.lit(float("nan"))).when(solar % 19 == 4, F.lit(None)).otherwise(F.col("temperature_c"))
    return events_panel(spark, sf).withColumns({"load_mw": load, "temperature_c": warm})


def rolling_missing(spark: SparkSession, sf: str) -> DataFrame:
    """W2, W3 over gaps: 23 of the 24 rows, and 1 of the 168, must be known."""

    cols = ["rolling_mean_24", "rolling_std_24", "rolling_mean_168", "rolling_std_168"]
    week = add_rolling_features(_gappy(spark, sf), FeatureConfig(rolling_windows=(168,)))
    both = add_rolling_features(week, FeatureConfig(rolling_windows=(24,), rolling_min_periods=23))
    return both.select("zone", "timestamp", *[_round(c) for c in cols])


def rolling_blocked(spark: SparkSession, sf: str) -> DataFrame:
    """W2, W3 of one series over gaps, cut into blocks: short, odd and long windows."""

    cfg = FeatureConfig(rolling_windows=(5, 17, 100), strategy="blocked", block_rows=1024)
    rows = add_rolling_features(_gappy(spark, sf).drop("zone"), cfg)
    return rows.select("timestamp", *[_round(f"rolling_{s}_{w}") for w in (5, 17, 100) for s in ("mean", "std")])


def supervised_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with a NaN feature or target go as those with a NULL one do."""

    panel = _gappy(spark, sf).withColumn("load_mw", F.when(F.col("load_mw") != float("inf"), F.col("load_mw")))
    cfg = FeatureConfig(lag_periods=(1, 24), rolling_windows=(24,))
    sup = build_supervised_frame(build_feature_frame(panel, cfg))
    return sup.frame.select("zone", "timestamp", "load_mw", "temperature_c", "lag_24", TARGET)


def residual_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Missing residuals teach nothing and are never flagged; zones without training rows use pooled parameters."""

    panel = _gappy(spark, sf).withColumn("load_mw", F.when(F.col("load_mw") != float("inf"), F.col("load_mw")))
    naive = add_lag_features(panel, FeatureConfig(lag_periods=(24,)))
    naive = naive.withColumn("residual", F.col("load_mw") - F.col("lag_24")).withColumn(
        "residual", F.when(F.col("residual").isNull(), float("nan")).otherwise(F.col("residual")))
    s = train_test_split(naive, 0.2, numbered=False)
    train, test = s.part("train"), s.part("test")
    taught = train.where("zone <> 'click'")
    parts = {
        "z": det.ResidualZScoreDetector(3.0).fit_residuals(train, "residual").score_residuals(test, "residual"),
        "robust": det.RobustResidualDetector(3.5).fit_residuals(train, "residual").score_residuals(test, "residual"),
        "zones": det.ResidualZScoreDetector(3.0, by=("zone",)).fit_residuals(taught, "residual").score_residuals(test, "residual"),
        "robust_zones": det.RobustResidualDetector(3.5, by=("zone",)).fit_residuals(taught, "residual").score_residuals(test, "residual"),
        "self": det.score_residuals(test, "load_mw", "lag_24", threshold=2.5),
    }
    out = None
    for name, scored in parts.items():
        part = scored.select(F.lit(name).alias("method"), "zone", "timestamp",
                             known("anomaly_score").alias("anomaly_score"), "is_anomaly")
        out = part if out is None else out.unionByName(part)
    return out.select("method", "zone", "timestamp", _round("anomaly_score"), "is_anomaly")


# ---------------------------------------------------------------- splits without row numbers


def selected_splits(spark: SparkSession, sf: str) -> DataFrame:
    """T1-T3 by the keys at the cuts: no row is moved or numbered."""

    from wattlane.catalog import hash_key

    panel = events_panel(spark, sf).select("zone", "timestamp")
    parts = {
        "two": train_test_split(panel, 0.2, purge=24, numbered=False),
        "three": train_validation_test_split(panel, validation_size=0.25, test_size=0.1, numbered=False),
        "random": train_test_split(panel, 0.3, split_method="random", order_key=hash_key(), numbered=False),
    }
    out = None
    for kind, s in parts.items():
        part = s.frame.select(F.lit(kind).alias("kind"), "zone", "timestamp", "split")
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- files


def _raw_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events as text, every 101st twice, with faults planted by integer rules."""

    eid = F.col("event_id")
    rows = read_table(spark, sf, "events").select(
        F.when(eid % 997 == 0, F.lit("not-a-time")).otherwise(F.col("ts").cast("string")).alias("timestamp"),
        F.when(eid % 977 == 0, F.lit("  ")).otherwise(F.col("event_type")).alias("zone"),
        F.when(eid % 991 == 0, F.lit("missing")).when(eid % 983 == 0, F.lit("1d")).otherwise((eid % 500).cast("string")).alias("load_mw"),
        (eid % 40).cast("string").alias("temperature_c"), (F.col("user_id") % 20).cast("string").alias("wind_speed_mps"),
        (eid % 1000).cast("string").alias("solar_radiation_wm2"),
        F.explode(F.when(eid % 101 == 0, F.array(F.lit(1), F.lit(1))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return rows.drop("copy")


def quarantined_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rejected rows with the first rule they break."""

    _, bad = quarantine(_raw_rows(spark, sf))
    return bad.select("timestamp", "zone", "load_mw", "reason")


def validated_write(spark: SparkSession, sf: str) -> DataFrame:
    """S3: the rows that pass, written in the scan that validates them and read back."""

    eid = F.col("solar_radiation_wm2")
    raw = _raw_rows(spark, sf).dropDuplicates().where(
        (F.col("timestamp") != "not-a-time") & (F.col("zone") != "  ") & ~F.col("load_mw").isin("missing", "1d"))
    return write_validated(raw.withColumn("load_mw", F.concat(F.lit(" "), "load_mw")), scratch(spark, "panel"),
                           columns=CANONICAL_COLUMNS).where(eid >= 0)


def panel_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A CSV of the event panel with quotes, commas and line breaks in its zones and notes, read and validated."""

    zone = F.concat(F.lit('say "'), F.col("zone"), F.lit('", x'))
    note = F.when(F.col("solar_radiation_wm2") % 7 == 0, F.lit('two\nlines, "quoted"')).otherwise(F.lit("plain"))
    panel = events_panel(spark, sf).select(*CANONICAL_COLUMNS).withColumn("zone", zone).withColumn("note", note)
    path = scratch(spark, "csv")
    csv_timestamps(panel).write.option("header", True).option("escape", '"').csv(path)
    back = read_panel_csv(spark, path)
    return back.select(*CANONICAL_COLUMNS, "note").drop(LINE)


QUERIES = {
    "rolling_missing": rolling_missing,
    "rolling_blocked": rolling_blocked,
    "supervised_missing": supervised_missing,
    "residual_missing": residual_missing,
    "selected_splits": selected_splits,
    "quarantined_rows": quarantined_rows,
    "validated_write": validated_write,
    "panel_csv": panel_csv,
}

_PANEL = """panel AS (
  SELECT ts AS "timestamp", event_type AS zone, CAST(value AS DOUBLE) AS load_mw,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS temperature_c,
         CAST(user_id % 20 AS DOUBLE) AS wind_speed_mps, CAST(event_id % 1000 AS DOUBLE) AS solar_radiation_wm2
  FROM events)"""
_GAPPY = f"""{_PANEL},
gappy AS (
  SELECT zone, "timestamp", wind_speed_mps, solar_radiation_wm2,
    CASE WHEN solar_radiation_wm2 % 13 = 5 OR solar_radiation_wm2 % 211 = 7 THEN NULL ELSE load_mw END AS load_mw,
    CASE WHEN solar_radiation_wm2 % 17 = 3 OR solar_radiation_wm2 % 19 = 4 THEN NULL ELSE temperature_c END AS temperature_c
  FROM panel)"""
_W = 'PARTITION BY zone ORDER BY "timestamp"'


def _rounded(x: str) -> str:
    return f"round(({x}) + (abs({x}) * 1e-12 + 1e-9), 6)"


def _rolling(win: int, least: int, over: str) -> str:
    frame = f"({over} ROWS BETWEEN {win} PRECEDING AND 1 PRECEDING)"
    return ",\n  ".join(
        f"CASE WHEN count(load_mw) OVER {frame} >= {least} THEN {_rounded(f'{f}(load_mw) OVER {frame}')} END AS rolling_{s}_{win}"
        for s, f in (("mean", "avg"), ("std", "stddev_samp")))


def _cut(kind: str, order: str, cuts: list[tuple[str, str]], last: str) -> str:
    cases = " ".join(f"WHEN rn < {end} THEN '{name}'" for name, end in cuts)
    return f"""SELECT '{kind}' AS kind, zone, "timestamp", CASE {cases} ELSE '{last}' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS rn FROM panel), n"""


def _share(size: float) -> str:
    return f"greatest(1, CAST(round_even(CAST(n AS DOUBLE) * {size}, 0) AS BIGINT))"


_HASH = '(((epoch_us("timestamp") % 1000003) * 7919 + 42) % 1000003)'
_RAW = """raw AS (
  SELECT CASE WHEN event_id % 997 = 0 THEN 'not-a-time' ELSE CAST(ts AS VARCHAR) END AS "timestamp",
    CASE WHEN event_id % 977 = 0 THEN '  ' ELSE event_type END AS zone,
    CASE WHEN event_id % 991 = 0 THEN 'missing' WHEN event_id % 983 = 0 THEN '1d' ELSE CAST(event_id % 500 AS VARCHAR) END AS load_mw,
    event_id, user_id, unnest(CASE WHEN event_id % 101 = 0 THEN [1, 2] ELSE [1] END) AS copy FROM events)"""


def _z(scale: str = "sd") -> str:
    return f"CASE WHEN {scale} > 0 THEN {scale} ELSE 1.0 END"


_RES = f"""{_GAPPY},
naive AS (
  SELECT zone, "timestamp", load_mw - lag(load_mw, 24) OVER ({_W}) AS r,
    row_number() OVER (ORDER BY "timestamp", zone) - 1 AS rn, count(*) OVER () AS n FROM gappy),
train AS (SELECT * FROM naive WHERE rn < n - {_share(0.2)}),
test AS (SELECT * FROM naive WHERE rn >= n - {_share(0.2)}),
z AS (SELECT avg(r) AS c, {_z('stddev_pop(r)')} AS s FROM train),
taught AS (SELECT * FROM train WHERE zone <> 'click'),
zt AS (SELECT avg(r) AS c, {_z('stddev_pop(r)')} AS s FROM taught),
zz AS (SELECT zone, avg(r) AS c, {_z('stddev_pop(r)')} AS s FROM taught GROUP BY zone),
md AS (SELECT median(r) AS c FROM train),
ms AS (SELECT any_value(c) AS c, median(abs(r - c)) AS s FROM train, md),
mt AS (SELECT any_value(c) AS c, median(abs(r - c)) AS s FROM taught, (SELECT median(r) AS c FROM taught)),
mz AS (
  SELECT zone, any_value(c) AS c, median(abs(r - c)) AS s FROM taught JOIN (SELECT zone, median(r) AS c FROM taught GROUP BY zone)
  USING (zone) GROUP BY zone),
se AS (SELECT avg(r) AS c, {_z('stddev_pop(r)')} AS s FROM test),
scores AS (
  SELECT 'z' AS method, zone, "timestamp", abs((r - c) / s) AS score, 3.0 AS t FROM test, z
  UNION ALL SELECT 'self', zone, "timestamp", abs((r - c) / s), 2.5 FROM test, se
  UNION ALL SELECT 'robust', zone, "timestamp", abs(0.6745 * (r - c) / s), 3.5 FROM test, ms
  UNION ALL SELECT 'zones', test.zone, "timestamp", abs((r - coalesce(zz.c, zt.c)) / coalesce(zz.s, zt.s)), 3.0
    FROM test CROSS JOIN zt LEFT JOIN zz ON zz.zone = test.zone
  UNION ALL SELECT 'robust_zones', test.zone, "timestamp", abs(0.6745 * (r - coalesce(mz.c, mt.c)) / coalesce(mz.s, mt.s)), 3.5
    FROM test CROSS JOIN mt LEFT JOIN mz ON mz.zone = test.zone)"""

ORACLES = {
    "rolling_missing": f"""WITH {_GAPPY}
SELECT zone, "timestamp", {_rolling(24, 23, _W)}, {_rolling(168, 1, _W)} FROM gappy""",
    "rolling_blocked": f"""WITH {_GAPPY}
SELECT "timestamp", {", ".join(_rolling(w, 1, 'ORDER BY "timestamp"') for w in (5, 17, 100))} FROM gappy""",
    "supervised_missing": f"""WITH {_GAPPY},
f AS (
  SELECT *, lag(load_mw, 1) OVER ({_W}) AS lag_1, lag(load_mw, 24) OVER ({_W}) AS lag_24,
    stddev_samp(load_mw) OVER ({_W} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS sd,
    lead(load_mw, 24) OVER ({_W}) AS target_load_mw FROM gappy)
SELECT zone, "timestamp", load_mw, temperature_c, lag_24, target_load_mw FROM f
WHERE load_mw IS NOT NULL AND temperature_c IS NOT NULL AND lag_1 IS NOT NULL AND lag_24 IS NOT NULL AND sd IS NOT NULL
  AND target_load_mw IS NOT NULL""",
    "residual_missing": f"""WITH {_RES}
SELECT method, zone, "timestamp", {_rounded('score')} AS anomaly_score, coalesce(score >= t, false) AS is_anomaly FROM scores""",
    "selected_splits": f"""WITH panel AS (SELECT ts AS "timestamp", event_type AS zone FROM events),
n AS (SELECT count(*) AS n FROM panel)
{_cut('two', '"timestamp", zone', [('train', f'n - {_share(0.2)} - 24'), ('purged', f'n - {_share(0.2)}')], 'test')}
UNION ALL {_cut('three', '"timestamp", zone',
                [('train', f'n - {_share(0.25)} - {_share(0.1)}'), ('validation', f'n - {_share(0.1)}')], 'test')}
UNION ALL {_cut('random', f'{_HASH}, "timestamp", zone', [('train', f'n - {_share(0.3)}')], 'test')}""",
    "quarantined_rows": f"""WITH {_RAW},
marked AS (
  SELECT *, CASE WHEN "timestamp" = 'not-a-time' THEN 'timestamp_unparsable'
    WHEN load_mw IN ('missing', '1d') THEN 'missing_or_non_numeric' WHEN zone = '  ' THEN 'blank_zone' END AS reason FROM raw),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY reason IS NULL, zone, "timestamp" ORDER BY copy) AS place FROM marked)
SELECT "timestamp", zone, load_mw, coalesce(reason, 'duplicate_keys') AS reason FROM placed WHERE reason IS NOT NULL OR place > 1""",
    "validated_write": f"""WITH {_RAW}
SELECT "timestamp"::TIMESTAMP AS "timestamp", zone, load_mw::DOUBLE AS load_mw, (event_id % 40)::DOUBLE AS temperature_c,
  (user_id % 20)::DOUBLE AS wind_speed_mps, (event_id % 1000)::DOUBLE AS solar_radiation_wm2
FROM raw WHERE copy = 1 AND "timestamp" <> 'not-a-time' AND zone <> '  ' AND load_mw NOT IN ('missing', '1d')""",
    "panel_csv": f"""WITH {_PANEL}
SELECT "timestamp", 'say "' || zone || '", x' AS zone, load_mw, temperature_c, wind_speed_mps, solar_radiation_wm2,
  CASE WHEN solar_radiation_wm2 % 7 = 0 THEN 'two' || chr(10) || 'lines, "quoted"' ELSE 'plain' END AS note FROM panel""",
}
