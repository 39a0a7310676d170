from datetime import date

import pytest
from pyspark.sql import functions as F

from tidegauge.functions import scalars as H
from tidegauge.operators import outliers as L
from tidegauge.operators import rules as R
from tidegauge.plans.series import filled
from tidegauge.plans.stages import preprocess
from tidegauge.sources import snapshots, tables

SF = "/root/testdata/sf0.001"


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_holidays_by_rule():
    assert H.us_holidays(2024).keys() >= {date(2024, 1, 1), date(2024, 1, 15), date(2024, 5, 27), date(2024, 6, 19), date(2024, 9, 2), date(2024, 11, 28), date(2024, 12, 25)}
    assert H.us_holidays(2021)[date(2021, 12, 31)] == "New Year (observed)" and date(2021, 7, 5) in H.us_holidays(2021) and date(2015, 6, 19) not in H.us_holidays(2015)


def test_scalars(spark):
    r = one(spark, H.thinned(F.sequence(F.lit(0), F.lit(999))).alias("a"), H.thinned(F.array(F.lit(1))).alias("b"), H.table_parts(F.lit("btc_usd_1h_raw")).alias("t"), H.likely_periods(F.lit("1h")).alias("p"))
    assert len(r.a) == 200 and r.a[:50] == list(range(50)) and r.a[-1] == 999 and r.b == [1]
    assert tuple(r.t) == ("btc_usd", "1h", "raw") and r.p == [24, 168]


def test_adaptive_weights_and_limits(spark):
    for quality, residual, want in ((0.4, 0.9, 1.0), (0.8, 0.06, 0.3), (0.6, 0.01, 0.6), (0.6, 0.03, 0.5), (0.8, 0.03, 0.5)):
        assert one(spark, L.adaptive_weights(F.lit(quality), F.lit(residual))[0].alias("w")).w == want
    assert one(spark, R.adapted_limit(3.0, F.lit(1.0), F.lit(0.0)).alias("x")).x == 3.0 and one(spark, R.adapted_limit(3.0, F.lit(1.0), F.lit(0.99)).alias("x")).x == 6.0


def test_chain_keeps_every_row_and_adds_up(spark):
    b = filled(spark, SF)
    out = preprocess(b, method="stl")
    p = out.toPandas()
    assert len(p) == b.count() and not p.duplicated(["ts_id", "open_time"]).any()
    good = p[p.status == "success"]
    assert len(good) and ((good.trend + good.seasonal + good.residual - good.y).abs() < 1e-8).all()
    assert set(p.outlier_type.dropna()) <= {"none", "statistical", "component", "consensus"}
    alone = preprocess(b.where("ts_id = 'crypto_view_1h'"), method="stl").toPandas().sort_values("open_time")
    within = p[p.ts_id == "crypto_view_1h"].sort_values("open_time")
    assert (alone.outlier_score.to_numpy() == within.outlier_score.to_numpy()).all()


def test_snapshots_rotate_and_restore(spark, tmp_path):
    c = tables.candles_ord(spark, SF)
    path, base = str(tmp_path / "t"), str(tmp_path / "b")
    snapshots.swap(c, path)
    snapshots.swap(c.limit(10), path)
    assert spark.read.parquet(path).count() == 10
    for _ in range(7):
        last = snapshots.backup(spark, {"t": path}, base)
    assert last == "gen-000007" and sorted(p.name for p in (tmp_path / "b").iterdir() if p.name.startswith("gen")) == [f"gen-{k:06d}" for k in range(3, 8)]
    assert snapshots.restore(spark, base, {"t": path}) == []
    assert snapshots.restore(spark, base, {"t": str(tmp_path / "again")}) == ["t"]
    assert spark.read.parquet(str(tmp_path / "again")).count() == 10 and snapshots.restore(spark, str(tmp_path / "none"), {}) == []


def test_retry():
    tries, waits = [], []

    @snapshots.retry(times=3, wait=waits.append)
    def f():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("again")
        return "ok"

    assert f() == "ok" and waits == [0.5, 1.0]
    with pytest.raises(OSError):
        snapshots.retry(times=2, wait=waits.append)(lambda: (_ for _ in ()).throw(OSError()))()


def test_command_line(spark, tmp_path, capsys):
    from tidegauge.plans import cli

    (tmp_path / "c.json").write_text('[{"kind": "add", "table": "raw", "column": "x", "before": null, "after": "int"}]')
    at = str(tmp_path / "reg")
    cli.main(["migrate", at, str(tmp_path / "c.json"), "--dry-run"])
    cli.main(["migrate", at, str(tmp_path / "c.json")])
    cli.main(["status", at])
    assert "version 1" in capsys.readouterr().out
    cli.main(["rollback", at])
    cli.main(["list"])
    out = capsys.readouterr().out
    assert "drop raw.x int -> None" in out and "c05_lacks" in out


def test_adjusted_p_values(spark):
    from tidegauge.operators import finance as N

    rows = [("a", h, 50, t) for h, t in ((1, 3.0), (5, 2.1), (10, 0.4), (20, -2.4))]
    got = {r.horizon: r for r in N.with_p_values(spark.createDataFrame(rows, "ts_id string, horizon int, n long, t_statistic double")).collect()}
    p = sorted((got[h].p_value, h) for h in got)
    want, least = {}, 1.0
    for rank in range(len(p), 0, -1):
        least = min(least, p[rank - 1][0] * len(p) / rank)
        want[p[rank - 1][1]] = least
    assert {h: r.p_adjusted for h, r in got.items()} == pytest.approx(want) and got[1].p_value == pytest.approx(0.00425, abs=2e-4)


def test_regime_confidence(spark):
    from math import erf, sqrt

    from tidegauge.operators import finance as N

    for v, t, a, z, n in ((0.3, 0.02, 0.1, 0.4, 200), (0.15, 0.5, -0.9, 0.0, 50), (0.9, 0.2, 0.3, 1.0, 8), (0.2, 0.1, 0.5, 0.2, 3)):
        got = one(spark, N.regime_confidence(F.lit(v), F.lit(t), F.lit(a), F.lit(z), F.lit(n)).alias("c")).c
        vol = erf(min(abs(v - 0.15), abs(v - 0.5)) / max(v / sqrt(2 * n), 1e-6) / sqrt(2))
        trend = erf(sqrt(t * n / 2)) if n > 10 else min(max(abs(t - 0.1), abs(t - 0.4)) / 0.1, 1)
        auto = erf(abs(a) * sqrt(n / 2)) if n > 3 else abs(a)
        assert got == pytest.approx(0.35 * vol + 0.35 * trend + 0.2 * auto + 0.1 * (1 - z), abs=1e-6)
