import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.kernels import series as K
from tidegauge.operators import analysis as A
from tidegauge.operators import windows as W

T = np.arange(480)
SINE = 10 + np.sin(2 * np.pi * T / 24)
RNG = np.random.default_rng(7)
WHITE = RNG.normal(size=500)
AR = np.zeros(500)
for _i in range(1, 500):
    AR[_i] = 0.9 * AR[_i - 1] + WHITE[_i]
WALK = np.cumsum(RNG.normal(size=500))


def test_distributions():
    assert K.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert K.chi2_sf(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-9)
    assert K.t_two_sided(2.228138851964939, 10) == pytest.approx(0.05, abs=1e-9)
    assert K.beta_cdf(2, 3, 0.4) == pytest.approx(0.5248, abs=1e-9)
    assert K.normal_cdf(1.959963984540054) == pytest.approx(0.975)


def test_autocorrelation_equals_definition():
    a = K.acf(AR, 5)
    x = AR - AR.mean()
    for k in range(1, 6):
        assert a[k] == pytest.approx((x[k:] @ x[:-k]) / (500 - k) / (x @ x / 500))
    assert a[1] > 0.8 and abs(K.acf(WHITE, 1)[1]) < 0.15


def test_unit_root_tests():
    assert K.adf(WHITE)[1] < 0.01 and K.adf(WALK)[1] > 0.05 and K.adf(AR)[1] < 0.05
    assert K.kpss(WHITE)[1] > 0.05 and K.kpss(np.arange(500) + WHITE)[1] == 0.01 and K.kpss(WALK)[0] > K.kpss(WHITE)[0]
    assert K.stationarity(WHITE)["is_stationary"] and not K.stationarity(np.cumsum(np.abs(WHITE)))["is_stationary"]
    assert K.stationarity(np.ones(50))["is_stationary"]
    assert K.mackinnon_p(-2.86) == pytest.approx(0.05, abs=0.003) and K.mackinnon_p(-3.43) == pytest.approx(0.01, abs=0.002)


def test_peaks():
    p, prom = K.find_peaks(np.array([0, 1, 0, 3, 3, 0, 2, 0.0]))
    assert list(p) == [1, 3, 6] and list(prom) == [1, 3, 2]
    assert list(K.find_peaks(np.array([0, 1, 0, 3, 0.0]), distance=3)[0]) == [3]


def test_periods():
    assert max(K.acf_periods(SINE), key=lambda r: r[1])[0] == 24
    assert max(K.spectral_periods(SINE), key=lambda r: r[1])[0] == 24
    assert abs(max(K.wavelet_periods(SINE), key=lambda r: r[1])[0] - 24) <= 2
    assert abs(A.detect(SINE)["period"] - 24) <= 1 and A.detect(SINE)["status"] != "not_detected"
    assert A.detect(np.ones(100))["status"] == "not_detected"


@pytest.mark.parametrize("method", ["stl", "robust_stl", "mstl", "fourier", "ssa", "additive_regression", "smoothed"])
def test_decompositions_add_up_and_find_the_season(method):
    y = SINE + 0.01 * T
    t, s, r = A.run_method(y, method, 24)
    assert np.allclose(t + s + r, y)
    want = np.sin(2 * np.pi * T / 24)
    assert np.corrcoef(s[48:-48], want[48:-48])[0, 1] > 0.97
    assert np.std(r[48:-48]) < 0.2


def test_stl_trend_of_a_line():
    t, s, r = K.stl(0.5 * np.arange(200) + 3, 12)
    assert np.abs(s).max() < 1e-6 and np.abs(r).max() < 1e-6


def test_robust_stl_is_not_moved_by_spikes():
    y = SINE.copy()
    y[[100, 200, 300]] += 30
    t, s, r = K.robust_stl(y, 24)
    assert np.abs(r[[100, 200, 300]]).min() > 25 and np.abs(np.delete(r, [100, 200, 300])).max() < 3


def test_boxcox():
    x = np.exp(RNG.normal(size=2000))
    lam, shift = K.boxcox_fit(x)
    assert abs(lam) < 0.06 and shift == 0
    assert np.allclose(K.boxcox_inverse(K.boxcox(x, 0.3), 0.3), x)
    assert K.boxcox_fit(x - 5)[1] > 4


def test_outlier_scores():
    x = np.r_[WHITE, 30.0]
    assert K.isolation_scores(x).argmax() == 500 and K.lof(x, 20).argmax() == 500
    assert (K.isolation_scores(x) == K.isolation_scores(x)).all()
    small = RNG.normal(size=30)
    d = np.abs(small[:, None] - small)
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, :5]
    far = np.sort(d, axis=1)[:, 4]
    density = 1 / np.maximum(np.take_along_axis(d, near, 1), far[near]).mean(axis=1)
    assert np.allclose(K.lof(small, 5), density[near].mean(axis=1) / density)


def test_whiteness():
    assert K.ljung_box(WHITE) > 0.01 and K.ljung_box(AR) < 1e-6


def test_canonical_features():
    f = K.canonical(AR)
    assert f["c22_acf_timescale"] > 3 and K.canonical(np.ones(20)) == {}
    assert 0.3 < K.canonical(WHITE)["c22_dfa"] < 0.7 < f["c22_dfa"]


def frame(spark, **series):
    rows = [(k, i, float(v)) for k, x in series.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "ts_id string, i long, y double")
    return df.select("ts_id", F.timestamp_seconds(F.col("i") * 3600).cast("timestamp_ntz").alias("open_time"), "y")


def test_status_rows_and_isolation_of_series(spark):
    both = frame(spark, a=SINE, b=AR, tiny=[1.0, 2.0], bad=[1.0] * 20 + [float("nan")], const=[3.0] * 40)
    for name in A.kernels():
        got = {r.ts_id: r.asDict(True) for r in A.analyse(both.repartition(3), "y", name).collect()}
        assert got["tiny"]["status"] == "error" and got["bad"]["status"] == "error" and len(got) == 5
        alone = A.analyse(frame(spark, a=SINE), "y", name).first().asDict(True)
        assert got["a"] == alone and alone["status"] == "success", (name, alone)
    d = A.decompose(both, "y").toPandas()
    assert set(d[d.ts_id.isin(["tiny", "bad", "const"])].status) == {"error"}
    a = d[d.ts_id == "a"].sort_values("open_time")
    assert np.allclose(a.trend + a.seasonal + a.residual, SINE)
    assert A.analyse(both.limit(0), "y", "acf").count() == 0


def test_normal_quantile_and_quantile_scaler(spark):
    from statistics import NormalDist

    ps = [1e-7, 0.001, 0.02, 0.3, 0.5, 0.77, 0.98, 0.9999]
    got = spark.createDataFrame([(p,) for p in ps], "p double").select(W.normal_quantile(F.col("p")).alias("z")).collect()
    assert np.allclose([r.z for r in got], [NormalDist().inv_cdf(p) for p in ps], rtol=1e-8, atol=1e-8)


def test_shape_legacy_and_smoothing():
    assert K.qq_correlation(WHITE) > 0.99 and K.qq_correlation(np.exp(2 * WHITE)) < 0.8
    assert K.is_multimodal(np.r_[WHITE, WHITE + 12]) and K.legacy_period(SINE) <= 24
    assert K.smoothing_search(10 + WALK)[0] > 0.8 > 0.3 > K.smoothing_search(10 + WHITE)[0]
