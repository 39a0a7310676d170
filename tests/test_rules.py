"""Table catalogue, crash-safe swaps, the quality facade and the edges of rules that the queries don't reach."""

import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.operators import calendar as C
from tidegauge.operators import rules as R
from tidegauge.sources import snapshots
from tidegauge.sources import tables as T

SF = "/root/testdata/sf0.001"


def test_catalogue_of_tables(spark, tmp_path):
    base = str(tmp_path)
    assert snapshots.list_tables(spark, f"{base}/none") == []
    for name in ("btc_1h_raw", "btc_1d_raw", "eth_1h_raw", "x__new"):
        assert snapshots.create_if_absent(spark, f"{base}/{name}", "a long, b string")
    assert not snapshots.create_if_absent(spark, f"{base}/btc_1h_raw", "a long")
    assert snapshots.list_tables(spark, base) == ["btc_1d_raw", "btc_1h_raw", "eth_1h_raw"]
    assert snapshots.list_tables(spark, base, "btc%") == ["btc_1d_raw", "btc_1h_raw"]
    assert snapshots.drop(spark, f"{base}/btc_1h", "_raw") and not snapshots.drop(spark, f"{base}/btc_1h", "_raw")
    assert "default" in snapshots.list_databases(spark, "def%") and snapshots.list_databases(spark, "no such%") == []
    (tmp_path / "assets.json").write_text('{"BTCUSDT": ["1h", "1d"],\n "ETHUSDT": ["1h"]}')
    got = snapshots.asset_config(spark, f"{base}/assets.json")
    assert sorted(tuple(r) for r in got.collect()) == [("BTCUSDT", "1d"), ("BTCUSDT", "1h"), ("ETHUSDT", "1h")]


def test_swap_survives_a_lost_driver(spark, tmp_path):
    """Lost between the renames: the old table is whole under its other name and comes back."""
    path = str(tmp_path / "t")
    snapshots.swap(spark.range(5), path)
    (tmp_path / "t").rename(tmp_path / "t__old")
    assert snapshots.recover(spark, path) and spark.read.parquet(path).count() == 5
    assert not snapshots.recover(spark, path)
    (tmp_path / "t").rename(tmp_path / "t__old")
    snapshots.swap(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7 and not (tmp_path / "t__old").exists()


def test_check_returns_result_or_error(spark):
    c = T.candles_evt(spark, SF)
    report, error = C.check(c, "crypto_view_1h", datetime(2024, 1, 30, 23))
    assert error is None and report.count() == 1
    assert C.check(c, "crypto_none_1h", datetime(2024, 1, 30))[0] is None
    assert "interval" in C.check(c, "crypto_view_7h", datetime(2024, 1, 30))[1]


def test_repaired_leaves_whole_series_alone(spark):
    rows = [("a_b_1h", datetime(2024, 1, 1, h), float(h)) for h in range(5)] + [("a_c_1h", datetime(2024, 1, 1, h), float(h)) for h in (0, 1, 4)]
    cols = [F.col("y").alias(x) for x in C.NUMERIC]
    df = spark.createDataFrame(rows + rows, "ts_id string, open_time timestamp_ntz, y double")
    df = df.select("ts_id", "open_time", *cols, F.lit(2).cast("long").alias("number_of_trades"))
    got = {(r.ts_id, r.open_time.hour): r.open for r in C.repaired(df, "1h").collect()}
    assert got == {(s, h): float(h) for s in ("a_b_1h", "a_c_1h") for h in range(5)}


def test_long_gaps_are_filled_in_linear_time(spark):
    """Fills look back in both orders: 200,000 rows of one series, most of them missing."""
    n = 200_000
    df = spark.range(n).select(F.lit("s").alias("ts_id"), (F.timestamp_seconds(F.col("id") * 3600)).cast("timestamp_ntz").alias("open_time"), F.when(F.col("id") % 50_000 == 100, F.col("id") * 2.0).alias("y"))
    got = C.interpolate_time(df, ["y"]).agg(F.count("y"), F.max("y"), F.sum(F.when(F.hour("open_time") == 3, F.col("y")))).first()
    assert got[0] == n - 100 and got[1] == 300_200.0
    rows = C.interpolate_rows(df, "y").agg(F.count("y"), F.min("y")).first()
    assert tuple(rows) == (n, 200.0)


def test_chi_squared_tail(spark):
    from tidegauge.kernels.series import chi2_sf

    rows = [(x, k) for x in (0.1, 1.0, 5.0, 18.3, 60.0) for k in range(1, 11)]
    df = spark.createDataFrame(rows, "x double, k int").withColumn("p", R.chi2_sf(F.col("x"), F.col("k"), 10))
    for r in df.collect():
        assert r.p == pytest.approx(chi2_sf(r.x, r.k), abs=2e-7)


def test_independence_of_few_rows(spark):
    rng = np.random.default_rng(3)
    rows = [("few", datetime(2024, 1, 1, h), float(h)) for h in range(4)] + [("white", datetime(2024, 1, 1 + k // 24, k % 24), float(v)) for k, v in enumerate(rng.normal(size=33))]
    rows += [("walk", datetime(2024, 1, 1 + k // 24, k % 24), float(v)) for k, v in enumerate(np.cumsum(rng.normal(size=300)))]
    got = {r.ts_id: r for r in R.independence(spark.createDataFrame(rows, "ts_id string, open_time timestamp_ntz, r double"), "r").collect()}
    assert (got["few"].lags, got["few"].p_value, got["few"].is_independent) == (0, 1.0, True)
    assert got["white"].lags == 6 and not got["walk"].is_independent


def test_rules_at_their_edges(spark):
    one = spark.range(1)
    v = lambda c: one.select(c.alias("v")).first().v
    assert v(R.composite({"mse": F.lit(None).cast("double")})) == 0.5
    assert v(R.composite({"mse": F.lit(0.0), "robustness": F.lit(1.0)})) == 1.0
    assert v(R.alpha_confidence(F.lit(0), F.lit(0), F.lit(0), F.lit(0.0), F.lit(0))) == 0.5
    assert v(R.legacy_period(F.lit(0), F.lit(None).cast("int"), F.lit(500), F.lit("1d"), F.lit(1000))) == 7
    assert v(R.legacy_period(F.lit(0), F.lit(None).cast("int"), F.lit(9), F.lit("9x"), F.lit(8))) == 1
    assert v(R.adapted_limit(3.0, F.lit(1.0), F.lit(1.0))) == 6.0
    assert v(R.adapted_limit(3.0, F.lit(1.0), F.lit(-0.6))) == pytest.approx(3 * math.sqrt(0.25))
    assert v(R.json_safe(F.lit(float("nan")))) is None and v(R.json_safe(F.lit(None).cast("double"))) is None
    assert v(R.property_or(F.lit("not json"), "k", 3)) == 3.0
    assert v(R.has_arity(F.lit(None).cast("array<int>"), 2)) is False
    assert v(R.outlier_method(F.lit(40), F.lit("1M"), F.lit(True), F.lit(1.0), F.lit(0.1), F.lit(0.0), F.lit(1.0), F.lit(2.0))) == "isolation_forest"


def test_masks_without_spread(spark):
    """A series whose median absolute deviation is 0 has no outliers by it."""
    from tidegauge.operators import stats as S

    rows = [("flat", datetime(2024, 1, 1 + k // 24, k % 24), 5.0 if k % 10 else 9.0) for k in range(60)]
    got = S.outlier_masks(spark.createDataFrame(rows, "ts_id string, open_time timestamp_ntz, y double"), "y").collect()
    assert not any(r.is_mad_outlier or r.is_zscore_outlier for r in got)


def test_walk_forward_folds(spark):
    rows = [(s, datetime(2024, 1, 1 + k // 24, k % 24), float(k)) for s, n in (("a", 25), ("b", 9)) for k in range(n)]
    got = R.walk_forward(spark.createDataFrame(rows, "ts_id string, open_time timestamp_ntz, y double"), 10, 5).collect()
    folds = {}
    for r in got:
        folds.setdefault((r.ts_id, r.fold, r.part), []).append(int(r.y))
    assert {k: (min(v), len(v)) for k, v in folds.items()} == {("a", f, p): ((5 * f, 10) if p == "train" else (5 * f + 10, 5)) for f in range(3) for p in ("train", "test")}


def test_schemas_become_statements_and_migrations_files(spark):
    from pyspark.sql import types as ty

    from tidegauge.operators import catalog

    old = {"t": ty._parse_datatype_string("a long, b string")}
    new = {"t": ty._parse_datatype_string("a string, c double")}
    changes = catalog.compare(old, new)
    again = catalog.load_changes(catalog.dump_changes(changes))
    assert again == changes and catalog.apply(old, again)["t"].simpleString() == "struct<a:string,c:double>"
    schema = ty.StructType([ty.StructField("a", ty.LongType(), False), ty.StructField("ym", ty.StringType())])
    spark.sql("DROP TABLE IF EXISTS made_by_statement")
    spark.sql(catalog.create_statement("made_by_statement", schema, ["ym"]))
    try:
        assert spark.table("made_by_statement").columns == ["a", "ym"]
        spark.sql(catalog.create_statement("made_by_statement", schema, ["ym"]))
    finally:
        spark.sql("DROP TABLE made_by_statement")


def test_failed_methods_fall_back_to_stl(spark, monkeypatch):
    from tidegauge.operators import analysis as A

    x = 10 + np.sin(np.arange(96) / 4)
    real = A.run_method
    monkeypatch.setattr(A, "run_method", lambda x, m, p: real(x, m, p) if m == "stl" else 1 / 0 if m == "ssa" else (x * np.nan,) * 3)
    for method in ("ssa", "fourier"):
        out = A._decomposer(method, 24)(x)
        assert set(out.method) == {"stl"} and set(out.status) == {"success"} and out.message.str.startswith(method).all()
    monkeypatch.setattr(A, "run_method", lambda *_: (x * np.nan,) * 3)
    assert set(A._decomposer("ssa", 24)(x).method) == {"mean"}
