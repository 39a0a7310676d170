"""Rules over series, components and scores: gates, checks, repairs of components, tests with their p-values, regimes.

Everything is an aggregation by series or an expression; only p-values of Student's t run as an Arrow function, on rows
that are aggregated already.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidegauge.kernels.series import t_two_sided
from tidegauge.operators.finance import erf
from tidegauge.operators.stats import clip, spearman
from tidegauge.operators.windows import by_time, lag, ratio, returns

#: How far components may miss the series, by method; weights of the composite (negative: less is better).
TOLERANCES = {"robust_stl": 0.02, "mstl": 0.02, "ssa": 0.025, "nbeats": 0.02, "fourier": 0.015, "tbats": 0.03, "prophet": 0.025}
DEFAULT_TOLERANCE = 0.02
WEIGHTS = {"mse": -0.3, "mae": -0.3, "aic": -0.1, "bic": -0.1, "residual_autocorr": 0.2, "seasonal_strength": 0.1, "trend_strength": 0.1, "robustness": 0.2}
#: Multipliers of the outlier search in a regime.
REGIME_THRESHOLDS = {
    "volatile": {"outlier_threshold_multiplier": 1.3, "contamination_factor": 1.5, "isolation_samples": 0.8, "lof_neighbors": 1.2},
    "trending": {"outlier_threshold_multiplier": 1.1, "contamination_factor": 0.8, "isolation_samples": 1.2, "lof_neighbors": 0.9},
    "ranging": {"outlier_threshold_multiplier": 0.9, "contamination_factor": 0.7, "isolation_samples": 1.1, "lof_neighbors": 1.0},
}
#: The longest period that a spectrum may give an interval, and the period without any candidate.
LEGACY_MOST = {"1h": 168, "12h": 60, "1d": 182, "3d": 60, "1w": 52, "1M": 12}
LEGACY_DEFAULT = {"1h": 24, "12h": 14, "1d": 7, "3d": 7, "1w": 52, "1M": 12}
#: Small, medium and large numbers of rows of an interval.
SIZES = {
    ("1s", "15s", "30s"): (180, 3600, 14400), ("1m", "5m"): (60, 720, 2880), ("15m", "30m"): (30, 192, 960), ("1h", "3h", "12h"): (30, 100, 500),
    ("1d", "3d"): (30, 90, 365), ("1w",): (12, 26, 260), ("1M",): (12, 36, 120),
}


def _by_code(code: Column, table: dict, default: float) -> Column:
    return F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[code], F.lit(default))


# --- gates and rows --------------------------------------------------------------------------------------------------


def has_arity(row: Column, n: int) -> Column:
    """Whether a row of values has as many as its table has columns; a null row has none."""
    return F.coalesce(F.size(row) == n, F.lit(False))


def json_safe(c: Column) -> Column:
    """Not-a-number and infinite values as null, as JSON has neither."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def property_or(props: Column, path: str, default) -> Column:
    """A field of a JSON property group, or a default where the group or the field is missing or null."""
    return F.coalesce(F.get_json_object(props, f"$.{path}").try_cast("double"), F.lit(float(default)))


def gates(df: DataFrame, c: str) -> DataFrame:
    """The first reason why a series can't be decomposed, null where there is none."""
    x = F.col(c)
    known = x.isNotNull() & ~F.isnan(x)
    per = df.groupBy("ts_id", F.when(known, x).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    v, n = F.col("_v"), F.col("_n")
    times = F.when(v.isNotNull(), n)
    s = per.groupBy("ts_id").agg(
        F.sum("_n").alias("n"), F.coalesce(F.sum(times), F.lit(0)).alias("known"), F.count("_v").alias("distinct"),
        F.max(times).alias("mode"), F.max(F.abs("_v")).alias("most"),
    )
    known = F.col("known")
    why = (
        F.when(F.col("n") < 10, "too short").when(1 - known / F.col("n") > 0.8, "too many missing").when((known > 0) & (F.col("distinct") < 3), "too few distinct values")
        .when(F.col("mode") / known > 0.95, "nearly constant").when(F.col("most") == float("inf"), "infinite values").when(F.col("most") > 1e10, "values over 1e10")
    )
    return s.select("ts_id", "n", why.alias("reason"))


def legacy_counts(df: DataFrame, c: str) -> DataFrame:
    """Missing values and values beyond three deviations of each series."""
    s = df.groupBy("ts_id").agg(F.avg(c).alias("_m"), F.stddev_pop(c).alias("_s"))
    far = (F.abs(F.col(c) - F.col("_m")) / F.col("_s") > 3).cast("int")
    return df.join(s, "ts_id").groupBy("ts_id").agg(F.count(F.when(F.col(c).isNull(), 1)).alias("missing_values"), F.coalesce(F.sum(far), F.lit(0)).alias("outliers"))


def align_components(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(ts_id, i, a, b)`` of two components ``(ts_id, open_time, value)``: by time, or by place where no time is common."""
    left, right = (x.select("ts_id", "open_time", F.col("value").alias(name)) for x, name in ((a, "a"), (b, "b")))
    common = left.join(right, ["ts_id", "open_time"])
    i = F.row_number().over(by_time())
    by_place = left.join(common.select("ts_id").distinct(), "ts_id", "left_anti").withColumn("i", i).drop("open_time")
    by_place = by_place.join(right.withColumn("i", i).drop("open_time"), ["ts_id", "i"])
    return common.withColumn("i", i).select("ts_id", "i", "a", "b").union(by_place.select("ts_id", "i", "a", "b"))


# --- components ------------------------------------------------------------------------------------------------------


def consistency(df: DataFrame, method: str) -> DataFrame:
    """How far components miss the series, as a share of its deviation, and whether the method may."""
    off = F.abs(F.col("trend") + F.col("seasonal") + F.col("residual") - F.col("y"))
    s = df.groupBy("ts_id").agg((F.avg(off) / (F.stddev_pop("y") + 1e-10)).alias("error"))
    return s.select("ts_id", "error", (F.col("error") <= TOLERANCES.get(method, DEFAULT_TOLERANCE)).alias("is_valid"))


def postprocess(df: DataFrame, volatility: DataFrame) -> DataFrame:
    """Shift the trend where trend and season miss the level, dampen an overgrown season of a volatile series."""
    miss = F.col("y") - F.col("trend") - F.col("seasonal")
    s = df.groupBy("ts_id").agg(F.avg(miss * miss).alias("_mse"), F.avg(miss).alias("_shift"), F.var_pop("y").alias("_v"), F.var_pop("seasonal").alias("_vs"))
    far = F.col("_mse") > 0.1 * F.col("_v")
    wild = (F.col("volatility") > 0.7) & (F.col("_vs") > 0.6 * F.col("_v"))
    damping = F.sqrt(0.6 * F.col("_v") / F.col("_vs")) * (1 - (F.col("volatility") - 0.7) * 0.5)
    s = s.join(volatility.select("ts_id", "volatility"), "ts_id").select("ts_id", F.when(far, F.col("_shift")).otherwise(0.0).alias("_shift"), F.when(wild, damping).otherwise(1.0).alias("_damping"), (far | wild).alias("_new"))
    out = df.join(s, "ts_id").withColumns({"trend": F.col("trend") + F.col("_shift"), "seasonal": F.col("seasonal") * F.col("_damping")})
    return out.withColumn("residual", F.when(F.col("_new"), miss).otherwise(F.col("residual"))).drop("_shift", "_damping", "_new")


def composite(scores: dict[str, Column]) -> Column:
    """The weighted mean of the scores at hand; what is better when less counts as 1 / (1 + score)."""
    part = {k: (1 / (1 + c) if WEIGHTS[k] < 0 else c) * abs(WEIGHTS[k]) for k, c in scores.items()}
    total = sum(F.when(c.isNotNull(), abs(WEIGHTS[k])).otherwise(0.0) for k, c in scores.items())
    mixed = sum(F.coalesce(c, F.lit(0.0)) for c in part.values())
    return F.when(total == 0, 0.5).otherwise(clip(mixed / total))


def independence(df: DataFrame, c: str, most: int = 10) -> DataFrame:
    """Ljung-Box statistic and p-value of a component at lag min(``most``, a fifth of the rows)."""
    s = df.groupBy("ts_id").agg(F.avg(c).alias("_m"), F.count(c).alias("_n"))
    z = df.join(s, "ts_id").withColumn("_z", F.col(c) - F.col("_m"))
    z = z.withColumns({f"_p{k}": F.col("_z") * lag("_z", k) for k in range(1, most + 1)})
    s = z.groupBy("ts_id").agg(F.max("_n").alias("n"), F.sum(F.col("_z") ** 2).alias("v"), *[F.sum(f"_p{k}").alias(f"p{k}") for k in range(1, most + 1)])
    lags = F.least(F.lit(most), F.floor(F.col("n") / 5)).cast("int")
    q = sum(F.when(lags >= k, ratio(F.col(f"p{k}"), F.col("v")) ** 2 / (F.col("n") - k)).otherwise(0.0) for k in range(1, most + 1))
    s = s.select("ts_id", lags.alias("lags"), F.when(lags >= 1, F.col("n") * (F.col("n") + 2) * q).otherwise(0.0).alias("statistic"))
    p = F.when(F.col("lags") < 1, 1.0).otherwise(chi2_sf(F.col("statistic"), F.col("lags"), most))
    return s.withColumn("p_value", p).withColumn("is_independent", F.col("p_value") > 0.05)


def chi2_sf(x: Column, df: Column, most: int) -> Column:
    """The upper tail of chi-squared for whole degrees of freedom up to ``most``; two degrees add one term."""
    half, out = x / 2, F.lit(None).cast("double")
    tail = {1: 1 - erf(F.sqrt(half)), 2: F.exp(-half)}
    gamma = {1: 3.141592653589793**0.5, 2: 1.0}
    for k in range(1, most + 1):
        if k > 2:
            gamma[k] = gamma[k - 2] * (k / 2 - 1)
            tail[k] = tail[k - 2] + F.pow(half, F.lit(k / 2 - 1)) * F.exp(-half) / gamma[k]
        out = F.when(df == k, tail[k]).otherwise(out)
    return out


# --- periods and methods ---------------------------------------------------------------------------------------------


def period_quality(confidence: Column, n_periods: Column) -> Column:
    return clip(confidence * (1 + 0.1 * F.least(n_periods, F.lit(5))))


def period_methods(frequency: Column, length: Column) -> Column:
    """Which period finders an interval's frequency and a series' length allow; the length has the last word."""
    every = F.when(frequency == "LOW", F.array(F.lit("acf"), F.lit("spectral"))).otherwise(F.array(F.lit("acf"), F.lit("spectral"), F.lit("wavelet")))
    return F.when(length == "TINY", F.array(F.lit("acf"))).when(length == "SHORT", F.array(F.lit("acf"), F.lit("spectral"))).otherwise(every)


def legacy_period(detected: Column, by_acf: Column, by_spectrum: Column, code: Column, n: Column) -> Column:
    """The median of the candidates, to the nearest even of two; under 2 the interval's usual period."""
    most = F.coalesce(F.create_map(*[F.lit(x) for kv in LEGACY_MOST.items() for x in kv])[code].cast("double"), n / 2)
    found = F.array_sort(F.array_compact(F.array(F.when(detected > 1, detected), by_acf, F.when(by_spectrum < most, by_spectrum))))
    k = F.size(found)
    middle = (F.get(found, F.floor((k - 1) / 2).cast("int")) + F.get(found, F.floor(k / 2).cast("int"))) / 2
    period = F.coalesce(F.bround(middle), F.lit(0.0)).cast("int")
    return F.when(period < 2, _by_code(code, LEGACY_DEFAULT, 1)).otherwise(period).cast("int")


def outlier_method(n: Column, code: Column, stationary: Column, mean: Column, std: Column, q1: Column, median: Column, q3: Column) -> Column:
    """Local outlier factors for small or steady series, isolation forests for large or lopsided ones."""
    small, medium, large = (_by_code(code, {c: v[k] for codes, v in SIZES.items() for c in codes}, (30, 100, 500)[k]) for k in range(3))
    lopsided = F.abs(q3 - median) / F.abs(median - q1 + 1e-10) > 1.5
    return (
        F.when(n < small, "lof").when(code.isin("1M", "3M"), "isolation_forest").when(stationary & (std / F.abs(mean + 1e-10) < 0.5), "lof")
        .when(n > large, "isolation_forest").when(lopsided, "isolation_forest").when(n < medium, "lof").otherwise("isolation_forest")
    )


def adapted_limit(limit: float, quality: Column, acf1: Column) -> Column:
    """A limit raised by up to a fifth for poor quality, and by up to twice for strong autocorrelation."""
    r = clip(acf1, -0.99, 0.99)
    inflation = F.when(F.abs(r) > 0.5, F.least(F.lit(2.0), F.sqrt((1 + r) / (1 - r)))).otherwise(1.0)
    return limit * (1 + (1 - clip(quality)) * 0.2) * inflation


# --- regimes, microstructure, alpha ----------------------------------------------------------------------------------


def regime_thresholds(regime: Column) -> Column:
    """A struct of multipliers: of the first kind that the regime's name holds, else 1."""
    names = list(REGIME_THRESHOLDS["volatile"])
    out = F.struct(*[F.lit(1.0).alias(n) for n in names])
    for kind, values in reversed(REGIME_THRESHOLDS.items()):
        out = F.when(regime.contains(kind), F.struct(*[F.lit(values[n]).alias(n) for n in names])).otherwise(out)
    return out


def regime_features(volatility: Column, trend: Column, acf1: Column, noise: Column, outliers: Column) -> dict[str, Column]:
    n = clip(noise, 0.001, 0.999)
    return {
        "trend_volatility_ratio": trend / F.greatest(volatility, F.lit(0.001)), "signal_noise_ratio": clip((1 - n) / n, 0.0, 100.0),
        "trending_persistence": F.greatest(acf1, F.lit(0.0)) * trend, "reverting_tendency": F.greatest(-acf1, F.lit(0.0)) * (1 - trend),
        "regime_stability": 1 - volatility * noise, "outlier_normalized": F.least(outliers / 0.1, F.lit(1.0)), "weak_form_efficiency": 1 - F.abs(acf1),
    }


def microstructure_quality(noise: Column, spread: Column, session: Column, clustering: Column, correlation: Column) -> Column:
    return clip(0.2 * (1 - noise) + 0.2 * (1 - spread) + 0.2 * (1 - session) + 0.2 * (1 - clustering) + 0.2 * F.abs(correlation))


def alpha_confidence(observations: Column, significant: Column, horizons: Column, magnitude: Column, duration: Column, least: int = 30) -> Column:
    parts = (observations / (3 * least), significant / F.greatest(horizons, F.lit(1)) , F.abs(magnitude), duration / 5)
    mean = sum(F.least(F.lit(1.0), p) for p in parts) / 4
    return F.when(horizons > 0, clip(mean, 0.1, 1.0)).otherwise(0.5)


def alpha_sharpe(alpha: Column, volatility: Column, magnitude: Column) -> Column:
    return clip(alpha / F.greatest(volatility, F.lit(0.01)) * F.least(F.lit(2.0), 1 + F.abs(magnitude)), -5.0, 5.0)


# --- tests and errors ------------------------------------------------------------------------------------------------


def t_p_value(t: Column, df: Column) -> Column:
    """Two-sided p-values of Student's t, for aggregated rows."""

    def p(t: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(a) or pd.isna(b) or b <= 0 else t_two_sided(float(a), float(b)) for a, b in zip(t, df, strict=True)], dtype="float64")

    return F.pandas_udf(p, DoubleType())(t, df)


def _with_correlation_p(s: DataFrame, r: str) -> DataFrame:
    free = (F.col("n") - 2).cast("double")
    return s.withColumn("p_value", t_p_value(F.col(r) * F.sqrt(ratio(free, 1 - F.col(r) ** 2)), free))


def significant_correlation(pairs: DataFrame, x: str, y: str, p: float = 0.05, least: int = 100) -> DataFrame:
    """Pearson's r of each series where there are enough rows and it is significant, else null."""
    s = pairs.groupBy("ts_id").agg(F.count(F.lit(1)).alias("n"), F.corr(x, y).alias("r"))
    s = _with_correlation_p(s, "r")
    return s.select("ts_id", "n", "p_value", F.when((F.col("n") >= least) & (F.col("p_value") < p), F.col("r")).alias("correlation"))


def volume_correlation(df: DataFrame, price: str, volume: str, p: float = 0.01, least: int = 30) -> DataFrame:
    """Spearman's rho of price returns and volume changes where it is significant, else 0."""
    r = returns(returns(df.select("ts_id", "open_time", price, volume), price, "_r"), volume, "_w").where("_r IS NOT NULL AND _w IS NOT NULL")
    s = r.groupBy("ts_id").agg(F.count(F.lit(1)).alias("n")).join(spearman(r, "_r", "_w"), "ts_id")
    s = _with_correlation_p(s, "rho")
    return s.select("ts_id", "n", "p_value", F.when((F.col("n") >= least) & (F.col("p_value") < p), F.col("rho")).otherwise(0.0).alias("correlation"))


def information(df: DataFrame, y: str, p: str, parameters: int = 3) -> DataFrame:
    """AIC and BIC of a forecast; infinite where it has no error."""
    s = df.groupBy("ts_id").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col(y) - F.col(p)) ** 2).alias("e"))
    fit = F.when(F.col("e") > 0, F.col("n") * F.log(F.col("e") / F.col("n"))).otherwise(float("inf"))
    return s.select("ts_id", (fit + 2 * parameters).alias("aic"), (fit + parameters * F.log("n")).alias("bic"))


def classification(df: DataFrame, y: str, p: str) -> DataFrame:
    """Accuracy, and F1 of each class weighted by how often it occurs."""
    cells = df.groupBy("ts_id", F.col(y).alias("_y"), F.col(p).alias("_p")).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("_y") == F.col("_p"), F.col("n")).otherwise(0)
    actual = cells.groupBy("ts_id", F.col("_y").alias("c")).agg(F.sum("n").alias("support"), F.sum(hit).alias("hits"))
    said = cells.groupBy("ts_id", F.col("_p").alias("c")).agg(F.sum("n").alias("said"))
    s = actual.join(said, ["ts_id", "c"], "left")
    f1 = 2 * F.col("hits") / (F.col("support") + F.coalesce("said", F.lit(0)))
    return s.groupBy("ts_id").agg((F.sum("hits") / F.sum("support")).alias("accuracy"), (F.sum(f1 * F.col("support")) / F.sum("support")).alias("f1_weighted"))


def walk_forward(df: DataFrame, n: int, step: int) -> DataFrame:
    """Walk-forward folds by row: train on ``n`` rows, test on the next ``step``, move on by ``step``."""
    i = F.row_number().over(by_time()) - 1
    rows = df.withColumns({"_i": i, "_n": F.count(F.lit(1)).over(Window.partitionBy("ts_id"))})
    last = F.floor((F.col("_n") - n - step) / step)
    first = F.greatest(F.lit(0), F.ceil((F.col("_i") - (n + step) + 1) / step))
    rows = rows.where(last >= 0).withColumn("fold", F.explode(F.sequence(first, F.greatest(first, F.least(last, F.floor(F.col("_i") / step))))))
    at = F.col("_i") - F.col("fold") * step
    return rows.where((F.col("fold") <= last) & (at >= 0) & (at < n + step)).withColumn("part", F.when(at < n, "train").otherwise("test")).drop("_i", "_n")
