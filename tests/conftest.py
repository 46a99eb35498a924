import os
import sys
import tempfile

import pandas as pd
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wattlane.session import get_spark  # noqa: E402

SMOKE = "/root/testdata/sf0.001"
PANEL_SCHEMA = (
    "timestamp TIMESTAMP_NTZ, zone STRING, load_mw DOUBLE, temperature_c DOUBLE, "
    "wind_speed_mps DOUBLE, solar_radiation_wm2 DOUBLE"
)


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="wattlane-test-ckpt-")
    s = get_spark("local[4]", app_name="wattlane-tests", shuffle_partitions=4,
                  extra_conf={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


def hourly(n, start="2026-01-01"):
    return pd.date_range(start, periods=n, freq="h")


def make_panel(spark, pdf: pd.DataFrame, schema: str = PANEL_SCHEMA):
    return spark.createDataFrame(pdf, schema)
