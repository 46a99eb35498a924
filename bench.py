"""Headline timings at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
``value`` sums the six workflow steps (feature build, row number, training,
backtest, tuning, isolation scoring); ``queries.oracle_suite`` times one run
of every registered query with an oracle and is not part of ``value``.
Each step is timed end to end including its Spark actions; the session is
warmed up once before timing.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from wattlane import catalog  # noqa: E402
from wattlane.operators.features import build_feature_frame, build_supervised_frame  # noqa: E402
from wattlane.operators.isoforest import fit_isolation_forest  # noqa: E402
from wattlane.operators.ordering import chronological_row_number, release_all  # noqa: E402
from wattlane.operators.splits import train_test_split  # noqa: E402
from wattlane.plans.backtest import BacktestConfig, run_backtest  # noqa: E402
from wattlane.operators.features import FeatureConfig  # noqa: E402
from wattlane.plans.train import TrainConfig, prepare_supervised, run_training  # noqa: E402
from wattlane.session import get_spark  # noqa: E402
from wattlane.sources.adapters import events_panel  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", app_name="wattlane-bench", shuffle_partitions=int(cpus),
                      extra_conf={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    events_panel(spark, sf_dir).agg(F.count(F.lit(1))).collect()  # warm-up: JVM, file listing

    def feature_build():
        sup = build_supervised_frame(build_feature_frame(events_panel(spark, sf_dir)))
        return sup.rows

    def row_number():
        return chronological_row_number(events_panel(spark, sf_dir)).agg(F.max("rn")).first()[0]

    def train_ridge():
        return run_training(events_panel(spark, sf_dir), TrainConfig()).forecast

    def backtest_one_pass():
        return run_backtest(events_panel(spark, sf_dir, single_zone=True), BacktestConfig())[0]["aggregate_metrics"]

    def threshold_tuning():
        return catalog.threshold_tuning(spark, sf_dir).collect()

    def isolation_scoring():
        sup = prepare_supervised(events_panel(spark, sf_dir), FeatureConfig())
        split = train_test_split(sup.frame, 0.2, rows=sup.rows)
        forest = fit_isolation_forest(split.part("train"), sup.features, rows=split.counts["train"])
        return forest.score(split.part("test")).agg(F.count_if("is_anomaly")).first()[0]

    def oracle_suite():
        n = 0
        for name, fn in catalog.ORACLE_QUERIES.items():
            n += len(fn(spark, sf_dir).collect())
            release_all()  # the result is collected; nothing built on its row numbers is used again
            spark.catalog.clearCache()
        return n

    steps = {
        "feature_build": feature_build,
        "row_number": row_number,
        "train_ridge": train_ridge,
        "backtest_one_pass": backtest_one_pass,
        "threshold_tuning": threshold_tuning,
        "isolation_scoring": isolation_scoring,
        "oracle_suite": oracle_suite,
    }
    timings: dict[str, float] = {}
    for name, fn in steps.items():
        t0 = time.perf_counter()
        fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        release_all()
        spark.catalog.clearCache()
    # headline value: the six workflow steps; the full registered-query sweep is reported alongside
    total = round(sum(v for k, v in timings.items() if k != "oracle_suite"), 3)
    print(json.dumps({"metric": "headline_workflows_sec", "value": total, "unit": "sec", "queries": timings, "sf": sf}))


if __name__ == "__main__":
    main()
