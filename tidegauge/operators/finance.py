"""Cross-series and event statistics for prices: betas, lead and lag, contagion, noise, spreads, regimes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.kernels.series import t_two_sided
from tidegauge.operators.calendar import forward_fill
from tidegauge.operators.joins import align, row_window
from tidegauge.operators.stats import clip, mad
from tidegauge.operators.windows import by_time, forward_returns, lag, ratio, returns, rolling_correlation, rows

#: Least rows, windows and limits.
MIN_ROWS, WINDOW, ISOLATED, MAX_LAG, FILL, MAD_CUT, VR_LAGS = 100, 50, 0.3, 20, 5, 3.0, (2, 5, 10)
#: How an anomaly type bears on alpha.
TYPE_WEIGHTS = {"momentum": 1.0, "mean_reversion": -1.0, "volatility": 0.5, "volume": 0.7, "structural": 0.8}
#: Volatility limits by class, trend and persistence limits.
VOLATILITY_LIMITS = {"crypto": (0.15, 0.50)}
DEFAULT_VOLATILITY, TREND_LIMITS, PERSISTENCE_LIMITS = (0.05, 0.25), (0.10, 0.40), (0.45, 0.55)


def clean_returns(df: DataFrame, c: str, cut: float = MAD_CUT) -> DataFrame:
    """Forward-filled (five rows at most) returns without those over ``cut`` MAD scores."""
    r = returns(forward_fill(df.select("ts_id", "open_time", c), c, FILL), c, "r").where("r IS NOT NULL")
    r = r.join(mad(r, "r"), "ts_id")
    return r.where((F.col("mad") == 0) | (0.6745 * F.abs(F.col("r") - F.col("median")) / F.col("mad") < cut)).select("ts_id", "open_time", "r")


def aligned_returns(df: DataFrame, reference: str, c: str) -> DataFrame:
    return align(clean_returns(df, c), reference, "r")


def market_beta(pairs: DataFrame) -> DataFrame:
    """Covariance, beta and correlation with the reference; null for few rows, no variance, or a beta over 10."""
    s = pairs.groupBy("ts_id").agg(
        F.count(F.lit(1)).alias("n"), F.covar_samp("target", "reference").alias("covariance"), F.var_samp("reference").alias("v"),
        F.var_samp("target").alias("vt"), F.corr("target", "reference").alias("correlation"),
    )
    half, root = (F.col("v") + F.col("vt")) / 2, F.sqrt(((F.col("v") - F.col("vt")) / 2) ** 2 + F.col("covariance") ** 2)
    condition = ratio(half + root, half - root)
    beta = ratio(F.col("covariance"), F.col("v"))
    fine = (F.col("n") >= MIN_ROWS) & (F.col("v") >= 1e-8) & (condition <= 1e8) & (F.abs(beta) <= 10)
    return s.select("ts_id", "n", "covariance", F.when(fine, beta).alias("beta"), F.when(F.col("n") >= MIN_ROWS, F.col("correlation")).alias("correlation"))


def lead_lag(pairs: DataFrame, max_lag: int = MAX_LAG) -> DataFrame:
    """The lag with the strongest correlation, positive where the reference leads, as a share of ``max_lag``.

    One Arrow group for each series and one pass for each lag; as columns of one window they made very wide rows.
    """

    def best(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("open_time", kind="stable")
        x, y = (df[c].to_numpy(float, na_value=np.nan) for c in ("target", "reference"))
        found = []
        for k in range(-max_lag, max_lag + 1):
            a, b = (x[k:], y[: len(y) - k]) if k >= 0 else (x[:k], y[-k:])
            both = np.isfinite(a) & np.isfinite(b)
            a, b = a[both] - a[both].mean() if both.any() else a[:0], b[both] - b[both].mean() if both.any() else b[:0]
            scale = np.sqrt((a @ a) * (b @ b))
            if scale > 0:
                found.append((abs(a @ b) / scale, -abs(k), k))
        strength, _, k = max(found, default=(None, 0, None))
        return pd.DataFrame({"ts_id": [df["ts_id"].iloc[0]], "lead_lag": [None if k is None else k / max_lag], "strength": [strength]}, dtype=object)

    return pairs.select("ts_id", "open_time", "target", "reference").groupBy("ts_id").applyInPandas(best, "ts_id string, lead_lag double, strength double")


def contagion(pairs: DataFrame, n: int = WINDOW) -> DataFrame:
    """Mean rolling correlation in the quarter of most volatile windows against the rest, adjusted for variance."""
    p = rolling_correlation(pairs, "target", "reference", n).withColumn("vol", F.stddev("reference").over(rows(n))).where("rolling_corr IS NOT NULL")
    cut = p.groupBy("ts_id").agg(F.percentile("vol", F.lit(0.75)).alias("cut"))
    p = p.join(cut, "ts_id").withColumn("crisis", F.col("vol") > F.col("cut"))
    s = p.groupBy("ts_id").agg(
        F.avg(F.when(F.col("crisis"), F.col("rolling_corr"))).alias("crisis"), F.avg(F.when(~F.col("crisis"), F.col("rolling_corr"))).alias("tranquil"),
        F.avg(F.when(F.col("crisis"), F.col("vol") ** 2)).alias("vc"), F.avg(F.when(~F.col("crisis"), F.col("vol") ** 2)).alias("vt"),
    )
    delta = ratio(F.col("vc"), F.col("vt")) - 1
    adjusted = F.col("crisis") / F.sqrt(1 + delta * (1 - F.col("crisis") ** 2))
    return s.select("ts_id", "crisis", "tranquil", adjusted.alias("adjusted"), (adjusted - F.col("tranquil")).alias("contagion"))


def isolation(pairs: DataFrame, n: int = WINDOW) -> DataFrame:
    p = rolling_correlation(pairs, "target", "reference", n).where("rolling_corr IS NOT NULL")
    c = F.col("rolling_corr")
    s = p.groupBy("ts_id").agg(F.avg((F.abs(c) < ISOLATED).cast("int")).alias("isolation_ratio"), F.stddev(c).alias("s"), F.avg(c).alias("m"))
    return s.select("ts_id", "isolation_ratio", (1 / (1 + ratio(F.col("s"), F.abs(F.col("m"))))).alias("stability"))


def variance_ratio_noise(df: DataFrame, c: str, lags=VR_LAGS) -> DataFrame:
    """1 less the mean variance ratio of overlapping k-row returns, at least 0."""
    r = returns(df, c, "r").where("r IS NOT NULL")
    r = r.withColumns({f"_s{k}": F.when(F.count("r").over(rows(k)) == k, F.sum("r").over(rows(k))) for k in lags})
    s = r.groupBy("ts_id").agg(F.var_samp("r").alias("v"), *[F.var_samp(f"_s{k}").alias(f"v{k}") for k in lags])
    mean = sum(ratio(F.col(f"v{k}"), k * F.col("v")) for k in lags) / len(lags)
    return s.select("ts_id", F.greatest(F.lit(0.0), 1 - mean).alias("noise"))


def roll_spread(df: DataFrame, c: str) -> DataFrame:
    r = returns(df, c, "r").where("r IS NOT NULL")
    r = r.withColumn("_p", lag("r"))
    rho = F.corr("r", "_p")
    return r.groupBy("ts_id").agg(F.least(F.lit(1.0), F.greatest(F.lit(0.0), -2 * rho) / 0.1).alias("roll_spread"))


def forward_panel(df: DataFrame, is_anomaly, c: str, horizons=(1, 5, 10, 20)) -> DataFrame:
    """Forward returns from anomalies that have room for the longest horizon, one row for each horizon."""
    f = forward_returns(df.withColumn("_hit", is_anomaly), c, horizons).where("_hit").where(F.col(f"fwd_{max(horizons)}").isNotNull())
    rows_ = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"fwd_{h}").alias("ret")) for h in horizons])
    return f.select("ts_id", "open_time", F.explode(rows_).alias("x")).select("ts_id", "open_time", "x.horizon", "x.ret")


def predictive_power(panel: DataFrame, least: int = 30) -> DataFrame:
    """Mean, deviation, information ratio, hit rate and t statistic of each horizon with enough rows."""
    s = panel.groupBy("ts_id", "horizon").agg(
        F.count(F.lit(1)).alias("n"), F.avg("ret").alias("mean"), F.stddev("ret").alias("std"), F.avg((F.col("ret") > 0).cast("int")).alias("hit_rate")
    ).where(F.col("n") >= least)
    ir = ratio(F.col("mean"), F.col("std"))
    return s.withColumns({"information_ratio": ir, "t_statistic": ir * F.sqrt("n")})


def alpha_score(mean, std, benchmark=None):
    """tanh of the excess over a benchmark, or of mean over deviation."""
    return F.tanh(mean - benchmark) if benchmark is not None else F.tanh(ratio(mean, std))


def alpha_potential(history, kind, magnitude, deviation):
    weight = F.create_map(*[F.lit(x) for kv in TYPE_WEIGHTS.items() for x in kv])[kind]
    raw = history * F.coalesce(weight, F.lit(0.5)) * F.tanh(2 * F.abs(magnitude)) / (1 + F.exp(-(deviation - 3)))
    return clip(raw, -1.0, 1.0)


def mean_reversion(df: DataFrame, is_event, c: str, k: int = 20) -> DataFrame:
    """How far prices come back within k rows of an event: share of the jump undone, and rows until half is."""
    w = row_window(df, is_event, c, k)
    s = w.groupBy("ts_id", "event_time").agg(
        F.avg(F.when(F.col("offset") < 0, F.col("value"))).alias("before"), F.max(F.when(F.col("offset") == 0, F.col("value"))).alias("at"),
        F.avg(F.when(F.col("offset") > 0, F.col("value"))).alias("after"),
    )
    return s.select("ts_id", "event_time", clip(1 - ratio(F.abs(F.col("after") - F.col("before")), F.abs(F.col("at") - F.col("before")))).alias("strength"))


def momentum(df: DataFrame, is_event, c: str, k: int = 20) -> DataFrame:
    """Whether the mean move after events goes on in the direction before."""
    w = row_window(df, is_event, c, k)
    s = w.groupBy("ts_id", "event_time").agg(
        F.min_by("value", "offset").alias("first"), F.max(F.when(F.col("offset") == 0, F.col("value"))).alias("at"), F.max_by("value", "offset").alias("last")
    )
    same = F.signum(F.col("at") - F.col("first")) == F.signum(F.col("last") - F.col("at"))
    return s.groupBy("ts_id").agg(F.avg(same.cast("int")).alias("persistence"), F.count(F.lit(1)).alias("n_events"))


def event_validation(df: DataFrame, is_event, c: str, reference: str, k: int = 3, own: float = 2.0, other: float = 1.5) -> DataFrame:
    """Events around which both the series and the reference moved: greatest MAD score of returns within k rows."""
    r = returns(df.withColumn("_hit", is_event), c, "r").where("r IS NOT NULL")
    m = mad(r, "r")
    r = r.join(m, "ts_id").withColumn("score", F.when(F.col("mad") > 0, 0.6745 * F.abs(F.col("r") - F.col("median")) / F.col("mad")).otherwise(0.0))
    r = r.withColumn("near", F.max("score").over(by_time().rowsBetween(-k, k)))
    ref = r.where(F.col("ts_id") == reference).select("open_time", F.col("near").alias("near_reference"))
    hit = r.where(F.col("_hit") & (F.col("ts_id") != reference)).join(ref, "open_time")
    return hit.select("ts_id", "open_time", "near", "near_reference", ((F.col("near") > own) & (F.col("near_reference") > other)).alias("is_valid"))


def regime(volatility, trend, acf1, asset: str = "crypto"):
    """Regime name from volatility, trend strength and persistence."""
    lo, hi = VOLATILITY_LIMITS.get(asset, DEFAULT_VOLATILITY)
    persistence = 0.7 * acf1 + 0.3 * trend
    return (
        F.when((volatility > hi) & (trend > TREND_LIMITS[1]), "volatile_trending")
        .when(volatility > hi, "volatile")
        .when((trend > TREND_LIMITS[1]) & (persistence > PERSISTENCE_LIMITS[1]), "trending")
        .when(persistence < PERSISTENCE_LIMITS[0], F.when(volatility < lo, "quiet").otherwise("mean_reverting"))
        .otherwise("normal")
    )


def cross_asset(df: DataFrame, reference: str, c: str) -> DataFrame:
    """Beta, lead and lag, contagion and isolation of every series against the reference: one row each."""
    p = aligned_returns(df, reference, c)
    out = market_beta(p)
    for other in (lead_lag(p), contagion(p), isolation(p)):
        out = out.join(other, "ts_id", "left")
    return out


def validation_summary(panel: DataFrame) -> DataFrame:
    """Of each series' forward returns: how many, share above zero, mean, worst and best."""
    return panel.groupBy("ts_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("ret") > 0).cast("int")).alias("success_rate"), F.avg("ret").alias("mean"), F.min("ret").alias("worst"), F.max("ret").alias("best")
    )


def session_effect(df: DataFrame, c: str, is_open) -> DataFrame:
    """Deviation of returns within sessions over that outside."""
    r = returns(df.withColumn("_open", is_open), c, "r").where("r IS NOT NULL")
    s = r.groupBy("ts_id").agg(F.stddev(F.when(F.col("_open"), F.col("r"))).alias("inside"), F.stddev(F.when(~F.col("_open"), F.col("r"))).alias("outside"))
    return s.select("ts_id", "inside", "outside", ratio(F.col("inside"), F.col("outside")).alias("session_effect"))


def tick_clustering(df: DataFrame, c: str, tick: float) -> DataFrame:
    """Share of values on whole ticks beyond the tenth that chance gives."""
    last = F.abs(F.round(F.col(c) / tick)) % 10
    return df.groupBy("ts_id").agg(F.greatest(F.lit(0.0), (F.avg((last == 0).cast("int")) - 0.1) / 0.9).alias("clustering"))


def volatility_regimes(df: DataFrame, c: str, n: int = WINDOW) -> DataFrame:
    """Rolling deviation of returns and whether it is in the top quarter."""
    r = returns(df.select("ts_id", "open_time", c), c, "r").where("r IS NOT NULL")
    r = r.withColumn("vol", F.when(F.count("r").over(rows(n)) == n, F.stddev("r").over(rows(n))))
    cut = r.groupBy("ts_id").agg(F.percentile("vol", F.lit(0.75)).alias("cut"))
    return r.join(cut, "ts_id").where("vol IS NOT NULL").select("ts_id", "open_time", "vol", (F.col("vol") > F.col("cut")).alias("is_high"))


def with_p_values(power: DataFrame) -> DataFrame:
    """Two-sided t-test p-values and their Benjamini-Hochberg adjustment within each series."""
    @F.pandas_udf("double")
    def p_value(t: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(a) else t_two_sided(float(a), float(b) - 1) for a, b in zip(t, n, strict=True)], dtype="float64")

    out = power.withColumn("p_value", p_value("t_statistic", F.col("n").cast("double")))
    up = Window.partitionBy("ts_id").orderBy("p_value", "horizon")
    m = F.count("p_value").over(Window.partitionBy("ts_id"))
    out = out.withColumn("_q", F.col("p_value") * m / F.row_number().over(up))
    down = Window.partitionBy("ts_id").orderBy(F.desc_nulls_last("p_value"), F.desc("horizon")).rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumn("p_adjusted", F.least(F.lit(1.0), F.min("_q").over(down))).drop("_q")


def erf(x):
    """The error function of values from 0 up, by a rational approximation (absolute error under 1.5e-7), in the JVM."""
    # Coefficients of the published approximation.
    t = 1 / (1 + 0.3275911 * x)
    poly = ((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t
    return 1 - poly * F.exp(-x * x)


def regime_confidence(volatility, trend, acf1, noise, n, asset: str = "crypto"):
    """How sure a regime is: distance of the volatility from its limits, significance of trend and autocorrelation, signal.

    For few rows (ten for the trend, three for the autocorrelation) the plain distances stand in for the tests.
    """
    lo, hi = VOLATILITY_LIMITS.get(asset, DEFAULT_VOLATILITY)
    spread = F.greatest(volatility / F.sqrt(2.0 * n), F.lit(1e-6))
    by_volatility = erf(F.least(F.abs(volatility - lo), F.abs(volatility - hi)) / spread / 2**0.5)
    far = F.greatest(F.abs(trend - TREND_LIMITS[0]), F.abs(trend - TREND_LIMITS[1]))
    by_trend = F.when(n > 10, erf(F.sqrt(trend * n / 2))).otherwise(F.least(far / 0.1, F.lit(1.0)))
    by_acf = F.when(n > 3, erf(F.abs(acf1) * F.sqrt(n / 2))).otherwise(F.abs(acf1))
    return clip(0.35 * clip(by_volatility) + 0.35 * clip(by_trend) + 0.20 * clip(by_acf) + 0.10 * clip(1 - noise))
