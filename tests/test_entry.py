import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["zone", "timestamp", "anomaly_score", "is_anomaly"]


def test_every_oracle_has_a_query():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert len(q) >= 40


def test_oracle_matches_spark_on_small_queries(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW events AS SELECT * FROM read_parquet('/root/testdata/sf0.001/events.parquet')")
    for name in ("calendar_features", "chrono_row_number", "reference_stats", "inject_labels", "threshold_tuning"):
        sp = E.queries()[name](spark, "/root/testdata/sf0.001").toPandas()
        dk = con.execute(E.oracle_sql()[name]).df()
        key = sorted(sp.columns)
        a = sp[key].sort_values(key).reset_index(drop=True)
        b = dk[key].sort_values(key).reset_index(drop=True)
        assert len(a) == len(b), name
        assert a.astype(str).equals(b.astype(str)), name


def test_fold_queries_on_a_table_too_short_for_one_fold(spark):
    # sf0.001 has 1,000 events: fewer than initial 1,000 + fold 168, so no fold exists (as in the SQL)
    q = E.queries()
    assert q["rolling_folds"](spark, "/root/testdata/sf0.001").count() == 0
    row = q["fold_mean_naive"](spark, "/root/testdata/sf0.001").first()
    assert row["fold_count"] == 0 and row["mean_mae"] is None
