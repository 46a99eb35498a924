"""DuckDB oracle SQL for the registered queries (same column names and types).

Tables are the driver's pre-registered views.  Doubles are rounded to 6
decimals exactly where the Spark side rounds; integers are BIGINT on both
sides.  Shared CTEs are built by the helpers below.
"""

from __future__ import annotations

import re

from wattlane.catalog_documents import ORACLES as DOCUMENT_ORACLES
from wattlane.catalog_models import oracles as model_oracles
from wattlane.catalog_panels import ORACLES as PANEL_ORACLES
# fixed values, written anew for the oracle: texts that are numbers, and texts that stand for a missing value
NUMBER = r"\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*|\s*[+-]?([iI][nN][fF]|[iI][nN][fF][iI][nN][iI][tT][yY])\s*"
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
           "NULL", "NaN", "None", "n/a", "nan", "null"]

PANEL = """panel AS (
  SELECT ts AS "timestamp", event_type AS zone, CAST(value AS DOUBLE) AS load_mw,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS temperature_c,
         CAST(user_id % 20 AS DOUBLE) AS wind_speed_mps,
         CAST(event_id % 1000 AS DOUBLE) AS solar_radiation_wm2
  FROM events)"""

SINGLE = PANEL.replace("event_type AS zone", "'ALL' AS zone")
LABEL = "(solar_radiation_wm2 % 50 = 0)"


def _iso(x: str) -> str:
    return (f"CASE WHEN epoch_us({x}) % 1000000 = 0 THEN strftime({x}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({x}, '%Y-%m-%dT%H:%M:%S.%f') END")


def _metrics(y: str, p: str) -> str:
    e = f"({y} - {p})"
    return f"""count(*) AS rows,
  round(avg(abs({e})), 6) AS mae,
  round(sqrt(avg({e} * {e})), 6) AS rmse,
  round(avg(CASE WHEN abs({y}) > 1e-12 THEN abs({e} / {y}) END) * 100.0, 6) AS mape,
  round(CASE WHEN count(*) < 2 THEN NULL
             WHEN var_pop({y}) * count(*) = 0 THEN CASE WHEN sum({e} * {e}) = 0 THEN 1.0 ELSE 0.0 END
             ELSE 1 - sum({e} * {e}) / (var_pop({y}) * count(*)) END, 6) AS r2"""


def _classify(prefix: str = "") -> str:
    tn, fp, fn, tp = (f"{prefix}{c}" for c in ("tn", "fp", "fn", "tp"))
    f1p = f"CASE WHEN 2*{tp}+{fp}+{fn} = 0 THEN 0.0 ELSE CAST(2*{tp} AS DOUBLE) / (2*{tp}+{fp}+{fn}) END"
    f1n = f"CASE WHEN 2*{tn}+{fn}+{fp} = 0 THEN 0.0 ELSE CAST(2*{tn} AS DOUBLE) / (2*{tn}+{fn}+{fp}) END"
    pos = f"({tp}+{fn}+{fp} > 0)"
    neg = f"({tn}+{fp}+{fn} > 0)"
    macro = (f"((CASE WHEN {pos} THEN {f1p} ELSE 0.0 END) + (CASE WHEN {neg} THEN {f1n} ELSE 0.0 END)) / "
             f"(CAST({pos} AS INTEGER) + CAST({neg} AS INTEGER))")
    return f"""round(CASE WHEN {tp}+{fp} = 0 THEN 0.0 ELSE CAST({tp} AS DOUBLE) / ({tp}+{fp}) END, 6) AS precision,
  round(CASE WHEN {tp}+{fn} = 0 THEN 0.0 ELSE CAST({tp} AS DOUBLE) / ({tp}+{fn}) END, 6) AS recall,
  round({macro}, 6) AS macro_f1"""


def _confusion(label: str, flag: str) -> str:
    return f"""count(*) FILTER (WHERE NOT {label} AND NOT {flag}) AS tn,
  count(*) FILTER (WHERE NOT {label} AND {flag}) AS fp,
  count(*) FILTER (WHERE {label} AND NOT {flag}) AS fn,
  count(*) FILTER (WHERE {label} AND {flag}) AS tp"""


W = 'PARTITION BY zone ORDER BY "timestamp"'


def _rolling(win: int, minp: int = 1, over: str = W, rnd: bool = True) -> str:
    frame = f"({over} ROWS BETWEEN {win} PRECEDING AND 1 PRECEDING)"
    m = f"avg(load_mw) OVER {frame}"
    s = f"stddev_samp(load_mw) OVER {frame}"
    if rnd:
        m, s = f"round({m}, 6)", f"round({s}, 6)"
    gate = f"count(load_mw) OVER {frame} >= {min(minp, win)}"
    return f"CASE WHEN {gate} THEN {m} END AS rolling_mean_{win}, CASE WHEN {gate} THEN {s} END AS rolling_std_{win}"


FEATS = f"""feats AS (
  SELECT zone, "timestamp", load_mw, temperature_c, wind_speed_mps, solar_radiation_wm2,
    CAST(hour("timestamp") AS BIGINT) AS hour, CAST(isodow("timestamp") - 1 AS BIGINT) AS day_of_week,
    CAST(month("timestamp") AS BIGINT) AS month,
    CAST(CASE WHEN isodow("timestamp") >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
    lag(load_mw, 1) OVER ({W}) AS lag_1, lag(load_mw, 24) OVER ({W}) AS lag_24,
    lag(load_mw, 168) OVER ({W}) AS lag_168,
    {_rolling(24)}, {_rolling(168)},
    lead(load_mw, 24) OVER ({W}) AS target_load_mw
  FROM panel)"""

FEATURE_NAMES = [
    "load_mw", "temperature_c", "wind_speed_mps", "solar_radiation_wm2", "hour", "day_of_week", "month",
    "is_weekend", "lag_1", "lag_24", "lag_168", "rolling_mean_24", "rolling_std_24", "rolling_mean_168",
    "rolling_std_168",
]
_complete = " AND ".join(
    f"({c} IS NOT NULL OR (SELECT count({c}) FROM feats) = 0)" for c in FEATURE_NAMES
)
SUPERVISED = f"""supervised AS (SELECT * FROM feats WHERE {_complete} AND target_load_mw IS NOT NULL)"""

NAIVE = f"""naive AS (
  SELECT *, load_mw - lag_24 AS residual FROM (
    SELECT *, lag(load_mw, 24) OVER ({W}) AS lag_24 FROM panel) WHERE lag_24 IS NOT NULL)"""


def _split2(src: str, size: float = 0.2) -> str:
    return f"""numbered AS (SELECT *, row_number() OVER (ORDER BY "timestamp", zone) - 1 AS rn FROM {src}),
  cut AS (SELECT count(*) - greatest(1, CAST(round_even(CAST(count(*) AS DOUBLE) * {size}, 0) AS BIGINT)) AS train FROM {src}),
  labeled AS (SELECT n.*, CASE WHEN rn < train THEN 'train' ELSE 'test' END AS split FROM numbered n, cut)"""


def _split3(src: str, v: float = 0.2, t: float = 0.2) -> str:
    return f"""numbered AS (SELECT *, row_number() OVER (ORDER BY "timestamp", zone) - 1 AS rn FROM {src}),
  cnt AS (SELECT count(*) AS n,
                 greatest(1, CAST(round_even(CAST(count(*) AS DOUBLE) * {v}, 0) AS BIGINT)) AS nv,
                 greatest(1, CAST(round_even(CAST(count(*) AS DOUBLE) * {t}, 0) AS BIGINT)) AS nt FROM {src}),
  labeled AS (SELECT x.*, CASE WHEN rn < n - nv - nt THEN 'train' WHEN rn < n - nt THEN 'validation' ELSE 'test' END AS split
              FROM numbered x, cnt)"""


def _robust_params(src: str, r: str, by: str | None = None) -> str:
    """median, raw MAD, IQR scale and the chosen scale (numpy-linear quantiles)."""

    g = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    join = f"USING ({by})" if by else "ON TRUE"
    return f"""q AS (SELECT {g}quantile_cont({r}, 0.25) AS q25, quantile_cont({r}, 0.5) AS med,
                   quantile_cont({r}, 0.75) AS q75 FROM {src} {grp}),
  m AS (SELECT {g}quantile_cont(abs({r} - q.med), 0.5) AS mad FROM {src} JOIN q {join} {grp}),
  params AS (SELECT {g}med AS residual_median, mad AS raw_mad, (q75 - q25) / 1.349 AS iqr_scale,
       CASE WHEN mad IS NOT NULL AND NOT isnan(mad) AND mad <> 0 AND NOT isinf(mad) THEN mad
            WHEN (q75 - q25) / 1.349 IS NOT NULL AND NOT isnan((q75 - q25) / 1.349) AND (q75 - q25) / 1.349 <> 0
                 AND NOT isinf((q75 - q25) / 1.349) THEN (q75 - q25) / 1.349
            ELSE 1.0 END AS residual_mad
     FROM q JOIN m {join})"""


def _zparams(src: str) -> str:
    return f"""zp AS (SELECT avg(residual) AS mu,
       CASE WHEN stddev_pop(residual) > 0 THEN stddev_pop(residual) ELSE 1.0 END AS sd FROM {src})"""


def _nulltokens() -> str:
    return ", ".join(f"'{t}'" for t in MISSING)


def _num_ok(x: str) -> str:
    return (f"({x} IS NOT NULL AND {x} NOT IN ({_nulltokens()}) AND regexp_full_match({x}, '{NUMBER}') "
            f"AND NOT isnan(TRY_CAST(trim({x}) AS DOUBLE)))")


RAW = """raw AS (
  SELECT CASE WHEN event_id % 997 = 0 THEN 'not-a-time' ELSE CAST(ts AS VARCHAR) END AS ts_text,
         CASE WHEN event_id % 977 = 0 THEN '  ' WHEN event_id % 947 = 0 THEN chr(9) WHEN event_id % 971 = 0 THEN 'NA' ELSE event_type END AS zone_text,
         CASE WHEN event_id % 991 = 0 THEN 'missing' WHEN event_id % 983 = 0 THEN '1d'
              WHEN event_id % 967 = 0 THEN ' 5 ' ELSE CAST(value AS VARCHAR) END AS load_text,
         json_extract_string(props, '$.k') AS temperature_text,
         CAST(user_id % 20 AS VARCHAR) AS wind_text,
         CASE WHEN event_id % 953 = 0 THEN 'inf' ELSE CAST(event_id % 1000 AS VARCHAR) END AS solar_text
  FROM events)"""


def _ts_parse(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR {x} IN ({_nulltokens()}) THEN NULL ELSE TRY_CAST(trim({x}) AS TIMESTAMP) END)"


def _tuning(labels: bool) -> str:
    label_cols = ", lbl" if labels else ""
    z = "abs((residual - zp.mu) / zp.sd)"
    rb = "abs(0.6745 * (residual - params.residual_median) / params.residual_mad)"
    head = f"""WITH {SINGLE}, {NAIVE}, {_split3('naive')},
  base AS (SELECT *, {LABEL} AS lbl FROM labeled),
  {_zparams("(SELECT * FROM base WHERE split = 'train')")},
  {_robust_params("(SELECT * FROM base WHERE split = 'train')", "residual")},
  scores AS (
    SELECT 'residual_zscore' AS method, split, {z} AS score{label_cols} FROM base, zp
    UNION ALL
    SELECT 'robust_residual' AS method, split, {rb} AS score{label_cols} FROM base, params),"""
    if labels:
        grid = ("grid AS (SELECT * FROM (VALUES " + ", ".join(
            [f"('residual_zscore', {i}, {t})" for i, t in enumerate((1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0))]
            + [f"('robust_residual', {i}, {t})" for i, t in enumerate((1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0, 6.0))]
        ) + ") g(method, grid_idx, threshold)),")
        body = f"""{grid}
  cands AS (
    SELECT method, grid_idx, CAST(threshold AS DOUBLE) AS threshold,
      {_confusion('lbl', '(score >= threshold)')}
    FROM scores JOIN grid USING (method) WHERE split = 'validation' GROUP BY method, grid_idx, threshold),
  cand_m AS (SELECT *, {_classify()} FROM cands),
  best AS (SELECT method, threshold FROM (
    SELECT *, row_number() OVER (PARTITION BY method ORDER BY macro_f1 DESC, grid_idx) AS rk FROM cand_m) WHERE rk = 1),
  final AS (SELECT method, threshold, count(*) FILTER (WHERE score >= threshold) AS detected_count,
      {_confusion('lbl', '(score >= threshold)')}
    FROM scores JOIN best USING (method) WHERE split = 'test' GROUP BY method, threshold)
SELECT method, threshold, detected_count, tn, fp, fn, tp, {_classify()} FROM final"""
        return head + body
    body = """  best AS (SELECT * FROM (VALUES ('residual_zscore', 3.0), ('robust_residual', 3.5)) b(method, threshold))
SELECT method, CAST(threshold AS DOUBLE) AS threshold, count(*) FILTER (WHERE score >= threshold) AS detected_count
FROM scores JOIN best USING (method) WHERE split = 'test' GROUP BY method, threshold"""
    return head + "\n" + body


def _inject() -> str:
    def digits(first: int) -> str:
        return f"('0x' || k[{first}:{first + 7}])::BIGINT"

    near = ", ".join(f"CASE WHEN (lag(e, {i}) OVER w).kind = 'level_shift' THEN lag(e, {i}) OVER w END" for i in range(1, 6))
    return f"""WITH {SINGLE},
  keyed AS (SELECT *, md5('42:' || zone || ':' || epoch_us("timestamp")) AS k, count(*) OVER () AS n FROM panel),
  ranked AS (SELECT *, row_number() OVER (ORDER BY k, "timestamp", zone) - 1 AS draw,
    least(n, greatest(1, CAST(round_even(CAST(n AS DOUBLE) * 0.02, 0) AS BIGINT))) AS c FROM keyed),
  drawn AS (SELECT *, CASE {digits(9)} % 3 WHEN 0 THEN 'spike' WHEN 1 THEN 'drop' ELSE 'level_shift' END AS kind,
    {digits(17)}::DOUBLE / 4294967296.0::DOUBLE AS u, CASE WHEN {digits(25)} % 2 = 0 THEN 1.0 ELSE -1.0 END::DOUBLE AS sign FROM ranked),
  events AS (SELECT *, CASE WHEN draw < c THEN {{'k': k, 'kind': kind,
    'm': CASE kind WHEN 'spike' THEN 1.35::DOUBLE + 0.45::DOUBLE * u WHEN 'drop' THEN 0.45::DOUBLE + 0.25::DOUBLE * u ELSE 1.0::DOUBLE END,
    'a': CASE WHEN kind = 'level_shift' THEN sign * (90.0::DOUBLE + 70.0::DOUBLE * u) ELSE 0.0::DOUBLE END}} END AS e FROM drawn),
  near AS (SELECT *, list_sort(list_filter([e, {near}], lambda x: x IS NOT NULL)) AS es FROM events
    WINDOW w AS (PARTITION BY zone ORDER BY "timestamp")),
  folded AS (SELECT *, CASE WHEN len(es) > 0 THEN list_reduce(es, lambda x, y:
    {{'k': y.k, 'kind': y.kind, 'm': x.m * y.m, 'a': x.a * y.m + y.a}}) END AS f FROM near)
SELECT zone, "timestamp", round(greatest(load_mw * coalesce(f.m, 1.0::DOUBLE) + coalesce(f.a, 0.0::DOUBLE), 0.0::DOUBLE), 3) AS load_mw,
  f IS NOT NULL AS is_anomaly, coalesce(f.kind, 'normal') AS anomaly_type FROM folded"""


def _sig(x: str, digits: int = 9) -> str:
    p = f"pow(10.0, floor(log10(abs({x}))))"
    return f"CASE WHEN {x} = 0 THEN 0.0 ELSE round({x} / {p} + 5e-12, {digits - 1}) * {p} END"


def _gram() -> str:
    xs = ["temperature_c", "wind_speed_mps", "solar_radiation_wm2"]
    items = [("n", "CAST(count(*) AS DOUBLE)"), ("sy", "sum(load_mw)"), ("syy", "sum(load_mw * load_mw)")]
    for i, a in enumerate(xs):
        items.append((f"s_{i}", f"sum({a})"))
        items.append((f"sxy_{i}", f"sum({a} * load_mw)"))
        for j in range(i, len(xs)):
            items.append((f"g_{i}_{j}", f"sum({a} * {xs[j]})"))
    union = "\n  UNION ALL ".join(f"SELECT '{n}' AS name, CAST({e} AS DOUBLE) AS value FROM panel" for n, e in items)
    return f"WITH {PANEL}, m AS ({union})\nSELECT name, {_sig('value')} AS value FROM m"


def _stats_union(src: str, cols: list[str]) -> str:
    return "\n  UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST(count({c}) AS DOUBLE) AS count, avg({c}) AS mean, stddev_pop({c}) AS std, "
        f"min({c}) AS min, max({c}) AS max FROM {src}" for c in cols
    )


NUMS = ["load_mw", "temperature_c", "wind_speed_mps", "solar_radiation_wm2"]


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["calendar_features"] = f"""WITH {PANEL}
SELECT zone, "timestamp", CAST(hour("timestamp") AS BIGINT) AS hour,
  CAST(isodow("timestamp") - 1 AS BIGINT) AS day_of_week, CAST(month("timestamp") AS BIGINT) AS month,
  CAST(CASE WHEN isodow("timestamp") >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend FROM panel"""
    q["lag_features"] = f"""WITH {PANEL}
SELECT zone, "timestamp", load_mw, lag(load_mw, 1) OVER ({W}) AS lag_1, lag(load_mw, 24) OVER ({W}) AS lag_24,
  lag(load_mw, 168) OVER ({W}) AS lag_168 FROM panel"""
    q["rolling_features"] = f"""WITH {PANEL}
SELECT zone, "timestamp", {_rolling(24)}, {_rolling(168)} FROM panel"""
    q["rolling_min_periods"] = f"""WITH {PANEL}
SELECT zone, "timestamp", {_rolling(24, 12)} FROM panel"""
    q["forecast_target"] = f"""WITH {PANEL}
SELECT zone, "timestamp", load_mw, lead(load_mw, 24) OVER ({W}) AS target_load_mw FROM panel"""
    cols = ", ".join(FEATURE_NAMES + ["target_load_mw"])
    q["feature_frame"] = f"""WITH {PANEL}, {FEATS}
SELECT zone, "timestamp", {cols} FROM feats"""
    q["blocked_feature_frame"] = q["feature_frame"]
    g = 'ORDER BY "timestamp"'
    q["global_series_features"] = f"""WITH {PANEL}
SELECT "timestamp", load_mw, lag(load_mw, 1) OVER ({g}) AS lag_1, lag(load_mw, 24) OVER ({g}) AS lag_24,
  {_rolling(24, 1, g)}, lead(load_mw, 24) OVER ({g}) AS target_load_mw FROM panel"""
    q["supervised_rows"] = f"""WITH {PANEL}, {FEATS}, {SUPERVISED}
SELECT zone, "timestamp", load_mw, target_load_mw FROM supervised"""
    q["payload_tail"] = f"""WITH {PANEL}, {FEATS}, {SUPERVISED}
SELECT zone, "timestamp", load_mw, target_load_mw FROM supervised ORDER BY zone DESC, "timestamp" DESC LIMIT 3"""

    numeric_bad = " OR ".join(f"NOT {_num_ok(c)}" for c in ("load_text", "temperature_text", "wind_text", "solar_text"))
    q["validation_report"] = f"""WITH {RAW},
  c AS (SELECT CAST(count(*) = 0 AS BIGINT) AS empty_input,
    count(*) FILTER (WHERE {_ts_parse('ts_text')} IS NULL) AS timestamp_unparsable,
    count(*) FILTER (WHERE zone_text IS NULL OR zone_text IN ({_nulltokens()}) OR {numeric_bad}) AS missing_or_non_numeric,
    count(*) FILTER (WHERE NOT regexp_matches(zone_text, '[^\\s]')) AS blank_zone FROM raw),
  d AS (SELECT coalesce(sum(n - 1), 0) AS duplicate_keys FROM (
    SELECT count(*) AS n FROM raw GROUP BY zone_text, {_ts_parse('ts_text')}))
SELECT rule, CAST(violations AS BIGINT) AS violations FROM (
  SELECT 'empty_input' AS rule, empty_input AS violations FROM c
  UNION ALL SELECT 'timestamp_unparsable', timestamp_unparsable FROM c
  UNION ALL SELECT 'missing_or_non_numeric', missing_or_non_numeric FROM c
  UNION ALL SELECT 'blank_zone', blank_zone FROM c
  UNION ALL SELECT 'duplicate_keys', duplicate_keys FROM d)"""
    q["duplicate_keys"] = """SELECT o_orderpriority AS zone, o_orderdate AS "timestamp", count(*) AS n
FROM orders GROUP BY o_orderpriority, o_orderdate HAVING count(*) > 1"""
    q["normalize_panel"] = f"""WITH {PANEL}
SELECT "timestamp", zone, load_mw, temperature_c, wind_speed_mps, solar_radiation_wm2 FROM panel"""

    q["chrono_row_number"] = f"""WITH {PANEL}
SELECT zone, "timestamp", row_number() OVER (ORDER BY "timestamp", zone) - 1 AS rn FROM panel"""
    q["train_test_split"] = f"""WITH {PANEL}, {_split2('panel')}
SELECT zone, "timestamp", rn, split FROM labeled"""
    q["three_way_split"] = f"""WITH {PANEL}, {_split3('panel')}
SELECT zone, "timestamp", rn, split FROM labeled"""
    key = '(((epoch_us("timestamp") % 1000003) * 7919 + 42) % 1000003)'
    q["hash_split"] = f"""WITH {PANEL},
  numbered AS (SELECT *, row_number() OVER (ORDER BY {key}, "timestamp", zone) - 1 AS rn FROM panel),
  cut AS (SELECT count(*) - greatest(1, CAST(round_even(CAST(count(*) AS DOUBLE) * 0.2, 0) AS BIGINT)) AS train FROM panel)
SELECT zone, "timestamp", rn, CASE WHEN rn < train THEN 'train' ELSE 'test' END AS split FROM numbered, cut"""
    q["rolling_folds"] = f"""WITH {SINGLE},
  numbered AS (SELECT "timestamp", row_number() OVER (ORDER BY "timestamp", zone) - 1 AS rn FROM panel),
  c AS (SELECT count(*) AS n FROM panel),
  folds AS (SELECT unnest(range(0, (n - 1000 - 168) // 168 + 1)) AS fold FROM c),
  t AS (SELECT f.fold, count(*) AS test_rows, min(x."timestamp") AS ts0, max(x."timestamp") AS ts1
        FROM folds f JOIN numbered x ON x.rn >= 1000 + f.fold * 168 AND x.rn < 1000 + f.fold * 168 + 168 GROUP BY f.fold),
  e AS (SELECT f.fold, x."timestamp" AS te FROM folds f JOIN numbered x ON x.rn = 1000 + f.fold * 168 - 1),
  s AS (SELECT "timestamp" AS tsst FROM numbered WHERE rn = 0)
SELECT CAST(t.fold AS BIGINT) AS fold, CAST(1000 + t.fold * 168 AS BIGINT) AS train_rows, t.test_rows,
  {_iso('tsst')} AS train_start, {_iso('te')} AS train_end, {_iso('ts0')} AS test_start, {_iso('ts1')} AS test_end
FROM t JOIN e USING (fold), s"""

    q["forecast_metrics_naive"] = f"""WITH {PANEL}, {NAIVE}
SELECT zone, {_metrics('load_mw', 'lag_24')} FROM naive GROUP BY zone"""
    fold_cte = f"""{SINGLE}, {NAIVE},
  numbered AS (SELECT *, row_number() OVER (ORDER BY "timestamp", zone) - 1 AS rn FROM naive),
  c AS (SELECT count(*) AS n FROM naive),
  folds AS (SELECT unnest(range(0, (n - 1000 - 168) // 168 + 1)) AS fold FROM c),
  tested AS (SELECT f.fold, x.* FROM folds f JOIN numbered x ON x.rn >= 1000 + f.fold * 168 AND x.rn < 1000 + f.fold * 168 + 168)"""
    q["fold_metrics_naive"] = f"""WITH {fold_cte}
SELECT CAST(fold AS BIGINT) AS fold, {_metrics('load_mw', 'lag_24')} FROM tested GROUP BY fold"""
    raw_metrics = _metrics("load_mw", "lag_24").replace("round(", "(").replace(", 6) AS", ") AS")
    q["fold_mean_naive"] = f"""WITH {fold_cte},
  per AS (SELECT fold, {raw_metrics} FROM tested GROUP BY fold)
SELECT count(*) AS fold_count, round(avg(CASE WHEN NOT isnan(mae) THEN mae END), 6) AS mean_mae,
  round(avg(CASE WHEN NOT isnan(rmse) THEN rmse END), 6) AS mean_rmse,
  round(avg(CASE WHEN NOT isnan(mape) THEN mape END), 6) AS mean_mape,
  round(avg(CASE WHEN NOT isnan(r2) THEN r2 END), 6) AS mean_r2 FROM per"""
    q["confusion_metrics"] = f"""WITH {PANEL}, {NAIVE},
  st AS (SELECT zone, avg(residual) AS mu, stddev_pop(residual) AS sd FROM naive GROUP BY zone),
  sc AS (SELECT n.zone, {LABEL} AS lbl,
    abs((residual - mu) / CASE WHEN sd IS NULL OR isnan(sd) OR sd = 0 OR isinf(sd) THEN 1.0 ELSE sd END) >= 2.0 AS flag
    FROM naive n JOIN st USING (zone)),
  cm AS (SELECT zone, {_confusion('lbl', 'flag')} FROM sc GROUP BY zone)
SELECT zone, tn, fp, fn, tp, {_classify()} FROM cm"""

    q["residual_zscore"] = f"""WITH {PANEL}, {NAIVE}, {_split2('naive')},
  {_zparams("(SELECT * FROM labeled WHERE split = 'train')")}
SELECT zone, "timestamp", round(abs((residual - mu) / sd), 6) AS anomaly_score, abs((residual - mu) / sd) >= 3.0 AS is_anomaly
FROM labeled, zp WHERE split = 'test'"""
    q["zone_zscore"] = f"""WITH {PANEL}, {NAIVE}, {_split2('naive')},
  zp AS (SELECT zone, avg(residual) AS mu, CASE WHEN stddev_pop(residual) > 0 THEN stddev_pop(residual) ELSE 1.0 END AS sd
         FROM labeled WHERE split = 'train' GROUP BY zone)
SELECT zone, "timestamp", round(abs((residual - mu) / sd), 6) AS anomaly_score, abs((residual - mu) / sd) >= 3.0 AS is_anomaly
FROM labeled LEFT JOIN zp USING (zone) WHERE split = 'test'"""
    rz = "abs(0.6745 * (residual - residual_median) / residual_mad)"
    q["robust_residual"] = f"""WITH {PANEL}, {NAIVE}, {_split2('naive')},
  {_robust_params("(SELECT * FROM labeled WHERE split = 'train')", "residual")}
SELECT zone, "timestamp", round({rz}, 6) AS anomaly_score, {rz} >= 3.5 AS is_anomaly
FROM labeled, params WHERE split = 'test'"""
    q["robust_scale_fallback"] = f"""WITH {PANEL},
  src AS (SELECT zone, CASE WHEN load_mw < 5 THEN load_mw - 5 WHEN load_mw > 60 THEN load_mw - 60 ELSE 0.0 END AS r FROM panel),
  {_robust_params('src', 'r', 'zone')}
SELECT zone, round(residual_median, 6) AS residual_median, round(raw_mad, 6) AS raw_mad,
  round(iqr_scale, 6) AS iqr_scale, round(residual_mad, 6) AS residual_mad FROM params"""
    q["residual_pairs"] = f"""WITH {PANEL},
  t AS (SELECT * FROM (SELECT *, lead(load_mw, 24) OVER ({W}) AS target_load_mw FROM panel) WHERE target_load_mw IS NOT NULL),
  {_split2('t')},
  zp AS (SELECT avg(target_load_mw - load_mw) AS mu,
    CASE WHEN stddev_pop(target_load_mw - load_mw) > 0 THEN stddev_pop(target_load_mw - load_mw) ELSE 1.0 END AS sd
    FROM labeled WHERE split = 'train')
SELECT zone, "timestamp", round(abs((target_load_mw - load_mw - mu) / sd), 6) AS anomaly_score,
  abs((target_load_mw - load_mw - mu) / sd) >= 3.0 AS is_anomaly FROM labeled, zp"""

    q["threshold_tuning"] = _tuning(True)
    q["no_label_defaults"] = _tuning(False)
    zs = "abs((residual - zp.mu) / zp.sd)"
    q["method_comparison"] = f"""WITH {PANEL}, {NAIVE}, {_split2('naive')},
  base AS (SELECT *, {LABEL} AS lbl FROM labeled),
  {_zparams("(SELECT * FROM base WHERE split = 'train')")},
  {_robust_params("(SELECT * FROM base WHERE split = 'train')", "residual")},
  sc AS (SELECT 'residual_zscore' AS method, 3.0 AS threshold, {zs} >= 3.0 AS flag, lbl FROM base, zp WHERE split = 'test'
         UNION ALL
         SELECT 'robust_residual', 3.5, {rz} >= 3.5, lbl FROM base, params WHERE split = 'test'),
  cm AS (SELECT method, CAST(threshold AS DOUBLE) AS threshold, count(*) FILTER (WHERE flag) AS detected_count,
         count(*) FILTER (WHERE lbl) AS labeled_anomaly_count, {_confusion('lbl', 'flag')} FROM sc GROUP BY method, threshold)
SELECT method, threshold, detected_count, labeled_anomaly_count, tn, fp, fn, tp, {_classify()} FROM cm"""

    q["reference_stats"] = f"""WITH {PANEL}, s AS ({_stats_union('panel', NUMS)})
SELECT "column", round(count, 6) AS count, round(mean, 6) AS mean, round(std, 6) AS std,
  round(min, 6) AS min, round(max, 6) AS max FROM s WHERE count > 0"""
    q["drift_compare"] = f"""WITH {PANEL},
  numbered AS (SELECT *, row_number() OVER (ORDER BY "timestamp", zone) - 1 AS rn FROM panel),
  half AS (SELECT count(*) // 2 AS h FROM panel),
  refrows AS (SELECT numbered.* FROM numbered, half WHERE rn < h),
  currows AS (SELECT numbered.* FROM numbered, half WHERE rn >= h),
  r AS ({_stats_union('refrows', NUMS)}),
  c AS ({_stats_union('currows', NUMS)})
SELECT "column", round(c.mean, 6) AS current_mean, round(r.mean, 6) AS reference_mean,
  round(c.mean - r.mean, 6) AS mean_delta,
  round(CASE WHEN coalesce(r.std, 0) > 0 THEN (c.mean - r.mean) / r.std END, 6) AS normalized_mean_delta,
  round(c.std, 6) AS current_std, round(coalesce(r.std, 0.0), 6) AS reference_std
FROM c JOIN r USING ("column") WHERE c.count > 0"""
    q["inject_labels"] = _inject()
    q["gram_moments"] = _gram()
    q["ridge_univariate"] = f"""WITH {PANEL},
  a AS (SELECT zone, count(*) AS rows, covar_pop(temperature_c, load_mw) AS cv,
    CASE WHEN sqrt(var_pop(temperature_c)) > 0 THEN sqrt(var_pop(temperature_c)) ELSE 1.0 END AS sd,
    avg(temperature_c) AS mx, avg(load_mw) AS my FROM panel GROUP BY zone),
  b AS (SELECT *, rows * cv / sd / (rows + 1.0) / sd AS coef FROM a)
SELECT zone, rows, round(coef, 6) AS coefficient, round(my - coef * mx, 6) AS intercept FROM b"""
    q["request_validation"] = f"""WITH {PANEL},
  numbered AS (SELECT *, row_number() OVER (ORDER BY "timestamp", zone) - 1 AS rn FROM panel),
  req AS (SELECT CAST(rn // 100 AS BIGINT) AS request_id, CAST(rn % 100 AS BIGINT) AS record_idx,
      solar_radiation_wm2 % 89 = 0 AS blank_name, solar_radiation_wm2 % 97 = 0 AS nan_value,
      CASE WHEN (rn // 100) % 7 = 3 AND rn % 100 = 0 THEN NULL ELSE load_mw END AS actual FROM numbered),
  sizes AS (SELECT request_id, count(*) AS recs, count(actual) AS acts FROM req GROUP BY request_id),
  r AS (SELECT request_id, record_idx,
      CASE WHEN recs > 1000 THEN 'too_many_records'
           WHEN blank_name THEN 'blank_feature_name'
           WHEN nan_value THEN 'non_finite_feature'
           WHEN acts > 0 AND acts < recs THEN 'partial_actuals' END AS reason
    FROM req JOIN sizes USING (request_id))
SELECT request_id, record_idx, reason IS NULL AS valid, reason FROM r"""
    lines = f"""{PANEL},
  numbered AS (SELECT *, row_number() OVER (ORDER BY "timestamp", zone) - 1 AS rn,
      CAST(solar_radiation_wm2 AS BIGINT) AS solar FROM panel),
  req AS (SELECT *, CAST(rn // 100 AS BIGINT) AS request_id, CAST(rn % 100 AS BIGINT) AS record_idx FROM numbered)"""
    q["request_ingest"] = f"""WITH {lines},
  marked AS (SELECT *, CASE WHEN rn % 300 >= 100 THEN 1 END AS act FROM req),
  sizes AS (SELECT request_id, count(*) AS recs, count(act) AS acts FROM marked GROUP BY request_id),
  r AS (SELECT request_id, record_idx,
      CASE WHEN request_id % 11 = 10 THEN 'unknown_field'
           WHEN solar % 83 = 0 THEN 'unknown_field'
           WHEN solar % 89 = 0 THEN 'blank_feature_name'
           WHEN solar % 97 = 0 THEN 'non_finite_feature'
           WHEN acts > 0 AND acts < recs THEN 'partial_actuals' END AS reason
    FROM marked JOIN sizes USING (request_id))
SELECT request_id, record_idx, reason IS NULL AS valid, reason FROM r"""
    q["pair_validation"] = f"""WITH {lines},
  r AS (SELECT request_id, record_idx,
      CASE WHEN request_id % 11 = 10 THEN 'unknown_field'
           WHEN solar % 83 = 0 THEN 'unknown_field'
           WHEN solar % 97 = 0 THEN 'malformed' END AS reason FROM req)
SELECT request_id, record_idx, reason IS NULL AS valid, reason FROM r"""
    literal = f"""{lines},
  rec AS (SELECT request_id, record_idx, load_mw, request_id % 9 <> 8 AS covered, rn % 10 <> 3 AS own,
      temperature_c, CASE WHEN request_id % 3 <> 1 THEN load_mw END AS actual FROM req)"""
    scored = """SELECT request_id, record_idx, round(prediction + abs(prediction) * 1e-12 + 1e-9, 6) AS prediction, error,
  round(score + abs(score) * 1e-12 + 1e-9, 6) AS anomaly_score, coalesce(score >= 1.5, false) AS is_anomaly
FROM (SELECT *, abs((actual - prediction - 1.0) / 20.0) AS score FROM p)"""
    message = "'Missing required features: temperature_c.'"
    q["batch_scoring"] = f"""WITH {literal},
  p AS (SELECT *, CASE WHEN covered THEN 1.0::DOUBLE + 0.5::DOUBLE * load_mw
      + 2.0::DOUBLE * CASE WHEN own THEN temperature_c ELSE 4.0::DOUBLE END END AS prediction,
      CASE WHEN NOT covered THEN {message} END AS error FROM rec)
{scored}"""
    q["stream_scoring"] = f"""WITH {literal},
  p AS (SELECT *, CASE WHEN covered AND own THEN 1.0::DOUBLE + 0.5::DOUBLE * load_mw + 2.0::DOUBLE * temperature_c END AS prediction,
      CASE WHEN NOT (covered AND own) THEN {message} END AS error FROM rec)
{scored}"""
    q["event_hours_dense"] = """WITH hourly AS (
    SELECT event_type AS zone, date_trunc('hour', ts) AS "timestamp", sum(value) AS load_mw,
           avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS temperature_c, CAST(count(*) AS DOUBLE) AS events
    FROM events GROUP BY 1, 2),
  bounds AS (SELECT zone, min("timestamp") AS lo, max("timestamp") AS hi FROM hourly GROUP BY zone),
  spine AS (SELECT zone, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS "timestamp" FROM bounds)
SELECT s.zone, s."timestamp", round(h.load_mw, 6) AS load_mw, round(h.temperature_c, 6) AS temperature_c, h.events
FROM spine s LEFT JOIN hourly h USING (zone, "timestamp")"""
    w7 = 'PARTITION BY zone ORDER BY "timestamp"'
    q["supplier_day_features"] = f"""WITH p AS (
    SELECT CAST(l_suppkey AS VARCHAR) AS zone, l_shipdate AS "timestamp", sum(l_extendedprice) AS load_mw
    FROM lineitem GROUP BY 1, 2)
SELECT zone, "timestamp", round(load_mw, 2) AS load_mw, round(lag(load_mw, 1) OVER ({w7}), 2) AS lag_1,
  round(lag(load_mw, 7) OVER ({w7}), 2) AS lag_7,
  CASE WHEN count(load_mw) OVER ({w7} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) >= 1
       THEN round(avg(load_mw) OVER ({w7} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 2) END AS rolling_mean_7,
  round(lead(load_mw, 1) OVER ({w7}), 2) AS target_load_mw
FROM p"""
    q["order_day_naive_metrics"] = f"""WITH p AS (
    SELECT o_orderpriority AS zone, o_orderdate AS "timestamp", sum(o_totalprice) AS load_mw FROM orders GROUP BY 1, 2),
  l AS (SELECT *, lag(load_mw, 7) OVER ({w7}) AS lag_7 FROM p),
  m AS (SELECT zone, {_metrics('load_mw', 'lag_7').replace("round(", "(").replace(", 6) AS", ") AS")}
        FROM l WHERE lag_7 IS NOT NULL GROUP BY zone)
SELECT zone, rows, {_sig('mae', 10)} AS mae, {_sig('rmse', 10)} AS rmse, round(mape, 6) AS mape, round(r2, 6) AS r2 FROM m"""
    return {**{k: _stable_round(v) for k, v in q.items()}, **DOCUMENT_ORACLES, **PANEL_ORACLES, **model_oracles()}


def _stable_round(sql: str) -> str:
    """Rewrite ``round(X, 6)`` / ``round(X, 2)`` as ``round(X + (abs(X) * 1e-12 + 1e-9), d)`` (as the Spark side)."""

    out, i = [], 0
    for m in re.finditer(r"round\(", sql):
        if m.start() < i:
            continue
        start = m.end()
        depth, j = 1, start
        while depth:
            ch = sql[j]
            depth += ch == "("
            depth -= ch == ")"
            j += 1
        inner = sql[start:j - 1]
        digits = inner[-1]
        if not (inner.endswith(", 6") or inner.endswith(", 2")):
            continue
        expr = _stable_round(inner[:-3])
        out.append(sql[i:m.start()])
        out.append(f"round(({expr}) + (abs({expr}) * 1e-12 + 1e-9), {digits})")
        i = j
    out.append(sql[i:])
    return "".join(out)
