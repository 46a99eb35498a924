"""Canonical panel schema and default values. All are fixed: they must equal the behaviour being reproduced."""

from __future__ import annotations

TIMESTAMP = "timestamp"
ZONE = "zone"
LOAD = "load_mw"
TARGET = "target_load_mw"

CANONICAL_COLUMNS: tuple[str, ...] = (
    "timestamp",
    "zone",
    "load_mw",
    "temperature_c",
    "wind_speed_mps",
    "solar_radiation_wm2",
)
NUMERIC_COLUMNS: tuple[str, ...] = (
    "load_mw",
    "temperature_c",
    "wind_speed_mps",
    "solar_radiation_wm2",
)
WEATHER_COLUMNS: tuple[str, ...] = ("temperature_c", "wind_speed_mps", "solar_radiation_wm2")
DUPLICATE_KEY: tuple[str, ...] = ("zone", "timestamp")

DEFAULT_LAGS: tuple[int, ...] = (1, 24, 168)
DEFAULT_WINDOWS: tuple[int, ...] = (24, 168)
LABEL_COLUMNS: tuple[str, ...] = ("is_anomaly", "anomaly_label", "label")
EXCLUDED_FEATURES: frozenset[str] = frozenset({"is_anomaly", "anomaly_label", "label", TARGET})

ZSCORE_GRID: tuple[float, ...] = (1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0)
ROBUST_GRID: tuple[float, ...] = (1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 5.0, 6.0)
CONTAMINATION_GRID: tuple[str | float, ...] = ("auto", 0.01, 0.02, 0.05, 0.1)
DEFAULT_THRESHOLDS = {"residual_zscore": 3.0, "robust_residual": 3.5}
METHODS: tuple[str, ...] = ("residual_zscore", "robust_residual", "isolation_forest")

MODIFIED_Z = 0.6745
IQR_TO_SIGMA = 1.349
MAPE_EPS = 1e-12

NULL_TOKENS: tuple[str, ...] = (
    "", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "<NA>", "#N/A", "-NaN", "-nan",
    "n/a", "#NA", "#N/A N/A", "-1.#IND", "-1.#QNAN", "1.#IND", "1.#QNAN",
)
