"""Statistics of series: moments, quartiles, entropy, trend and noise, outlier masks and their agreement.

Two-pass statistics (MAD, fences) aggregate by series and join the few rows of the result back; nothing runs over an
unpartitioned window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.windows import by_time, lag, ratio, returns, sample_kurtosis, sample_skewness

#: Thresholds and weights of the outlier masks.
Z_LIMIT, IQR_FACTOR, MAD_LIMIT, MAD_SCALE, CONSENSUS = 3.5, 1.3, 3.5, 0.6745, 0.5
WEIGHTS = {"is_mad_outlier": 0.5, "is_iqr_outlier": 0.3, "is_zscore_outlier": 0.2}
TINY = 1e-10


def clip(c: Column, lo: float = 0.0, hi: float = 1.0) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def basic(df: DataFrame, c: str) -> DataFrame:
    """Counts, mean, deviation, extremes, quartiles, bias-corrected skewness and kurtosis."""
    q = F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    s = df.groupBy("ts_id").agg(
        F.count(F.lit(1)).alias("length"), F.count(c).alias("_n"), F.avg(c).alias("mean"), F.stddev(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"),
        q.alias("_q"), sample_skewness(c).alias("skewness"), sample_kurtosis(c).alias("kurtosis"),
    )
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    q1, med, q3 = (zero(F.col("_q")[k]) for k in range(3))
    return s.select(
        "ts_id", "length", (F.col("length") - F.col("_n")).alias("missing_values"), (1 - F.col("_n") / F.col("length")).alias("missing_ratio"),
        *[zero(F.col(x)).alias(x) for x in ("mean", "std", "min", "max", "skewness", "kurtosis")],
        q1.alias("q1"), med.alias("median"), q3.alias("q3"), (q3 - q1).alias("iqr"),
    )


def volatility(mean: Column, std: Column) -> Column:
    return F.when(std.isNull(), 0.0).when(mean == 0, std).otherwise(std / F.abs(mean))


def trend_and_noise(df: DataFrame, c: str) -> DataFrame:
    """Volatility, trend strength (relative slope times R squared) and noise level (deviation of second differences)."""
    df = df.withColumn("_i", F.row_number().over(by_time()) - 1).withColumn("_d", F.col(c) - 2 * lag(c, 1) + lag(c, 2))
    y, x = F.col(c), F.col("_i").cast("double")
    s = df.groupBy("ts_id").agg(
        F.avg(c).alias("m"), F.stddev(c).alias("s"), F.regr_slope(y, x).alias("slope"), F.regr_r2(y, x).alias("r2"), F.stddev("_d").alias("sd")
    )
    strength = F.least(F.lit(1.0), 100 * F.abs(F.col("slope")) / (F.abs(F.col("m")) + TINY)) * F.col("r2")
    noise = F.when(F.col("s") > 0, F.col("sd") / F.col("s")).otherwise(0.0)
    return s.select("ts_id", volatility(F.col("m"), F.col("s")).alias("volatility"), clip(strength).alias("trend_strength"), clip(noise).alias("noise_level"))


def return_stats(df: DataFrame, c: str) -> DataFrame:
    r = returns(df.select("ts_id", "open_time", c), c)
    return r.groupBy("ts_id").agg(F.avg("returns").alias("returns_mean"), F.stddev("returns").alias("returns_volatility"), F.count("returns").alias("returns_count"))


def mad(df: DataFrame, c: str) -> DataFrame:
    """Median and median absolute deviation of each series."""
    med = df.groupBy("ts_id").agg(F.median(c).alias("median"))
    off = df.join(med, "ts_id").groupBy("ts_id").agg(F.first("median").alias("median"), F.median(F.abs(F.col(c) - F.col("median"))).alias("mad"))
    return off


def histogram_entropy(df: DataFrame, c: str, bins: int) -> DataFrame:
    """Entropy in nats of equal-width bins between a series' extremes, the last one closed."""
    ends = df.groupBy("ts_id").agg(F.min(c).alias("lo"), F.max(c).alias("hi"), F.count(c).alias("n"))
    b = F.least(F.floor((F.col(c) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1))
    counts = df.join(ends.where("hi > lo"), "ts_id").where(F.col(c).isNotNull()).groupBy("ts_id", "n", b.alias("bin")).agg(F.count(F.lit(1)).alias("k"))
    p = F.col("k") / F.col("n")
    return counts.groupBy("ts_id").agg((-F.sum(p * F.log(p))).alias("entropy"))


def outlier_masks(df: DataFrame, c: str, z: float = Z_LIMIT, iqr: float = IQR_FACTOR, mad_limit: float = MAD_LIMIT) -> DataFrame:
    """The rows with three masks: robust z-score, interquartile fence, MAD."""
    q = df.groupBy("ts_id").agg(F.percentile(c, F.array(F.lit(0.25), F.lit(0.75))).alias("_q"), F.count(c).alias("_n"))
    stats = mad(df, c).join(q, "ts_id")
    out = df.join(stats, "ts_id")
    score = F.when(F.col("mad") >= TINY, MAD_SCALE * F.abs(F.col(c) - F.col("median")) / F.col("mad")).otherwise(0.0)
    width = F.col("_q")[1] - F.col("_q")[0]
    outside = (F.col(c) < F.col("_q")[0] - iqr * width) | (F.col(c) > F.col("_q")[1] + iqr * width)
    mask = lambda x: F.coalesce(x, F.lit(False))
    return out.select(
        *df.columns, mask(score > z).alias("is_zscore_outlier"), mask(outside & (F.col("_n") >= 4)).alias("is_iqr_outlier"), mask(score > mad_limit).alias("is_mad_outlier")
    )


def consensus(df: DataFrame) -> DataFrame:
    """Weighted vote and the plain vote of two."""
    total = sum(F.col(k).cast("int") * w for k, w in WEIGHTS.items())
    votes = sum(F.col(k).cast("int") for k in WEIGHTS)
    return df.withColumns({"consensus_score": total, "is_outlier": total >= CONSENSUS, "is_outlier_votes": votes >= 2})


def outlier_summary(df: DataFrame) -> DataFrame:
    n = {k: F.sum(F.col(k).cast("long")) for k in WEIGHTS}
    s = df.groupBy("ts_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_outlier").cast("long")).alias("n_outliers"), F.greatest(*n.values()).alias("most"))
    agreement = F.when(F.col("most") > 0, F.col("n_outliers") / F.col("most")).otherwise(0.0)
    return s.select("ts_id", "n_outliers", (F.col("n_outliers") / F.col("n")).alias("outlier_ratio"), agreement.alias("agreement"))


def outlier_statistics(df: DataFrame, c: str) -> DataFrame:
    """Variance of outliers against the rest, mean distance to the rest's median, spread of the gaps between outliers."""
    df = df.withColumn("_i", F.row_number().over(by_time()))
    normal = df.where(~F.col("is_outlier")).groupBy("ts_id").agg(F.variance(c).alias("vn"), F.median(c).alias("mn"))
    hit = df.where("is_outlier").withColumn("_gap", F.col("_i") - F.lag("_i").over(by_time()))
    out = hit.join(normal, "ts_id").groupBy("ts_id").agg(
        F.variance(c).alias("vo"), F.first("vn").alias("vn"), F.avg(F.abs(F.col(c) - F.col("mn"))).alias("mean_distance"), F.stddev_pop("_gap").alias("gap_std")
    )
    ratio_ = F.when(F.col("vn") < TINY, F.lit(float("inf"))).otherwise(F.col("vo") / F.col("vn"))
    return out.select("ts_id", ratio_.alias("variance_ratio"), "mean_distance", "gap_std")


def data_quality(missing: Column, outliers: Column, noise: Column, stationary: Column) -> Column:
    q = (1 - missing) * (1 - F.least(outliers, F.lit(0.5))) * (1 - 0.5 * noise)
    return clip(q * F.when(stationary, 1.1).otherwise(1.0))


def mask_independence(df: DataFrame, limit: float = 0.7) -> DataFrame:
    """Correlation of each pair of masks (rank and plain correlation are one for two values)."""
    names, rows = sorted(WEIGHTS), []
    x = {k: F.col(k).cast("double") for k in names}
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    s = df.groupBy("ts_id").agg(*[F.corr(x[a], x[b]).alias(f"{a}|{b}") for a, b in pairs])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs])
    return s.select("ts_id", F.explode(rows).alias("p")).select("ts_id", "p.a", "p.b", "p.r", (F.abs("p.r") > limit).alias("dependent"))


def significant_lags(df: DataFrame, c: str, max_lag: int, top: int, z: float = 1.96) -> DataFrame:
    """Autocorrelations of the first lags over z / sqrt(n), the strongest first; one pass of lags in one window."""
    mean = df.groupBy("ts_id").agg(F.avg(c).alias("_m"), F.count(c).alias("_n"), F.var_pop(c).alias("_v"))
    x = df.join(mean, "ts_id").withColumn("_x", F.col(c) - F.col("_m"))
    x = x.withColumns({f"_l{k}": F.col("_x") * F.lag("_x", k).over(by_time()) for k in range(1, max_lag + 1)})
    s = x.groupBy("ts_id", "_n", "_v").agg(*[F.sum(f"_l{k}").alias(f"_s{k}") for k in range(1, max_lag + 1)])
    rows = F.array(*[F.struct(F.lit(k).alias("lag"), ratio(F.col(f"_s{k}"), (F.col("_n") - k) * F.col("_v")).alias("acf")) for k in range(1, max_lag + 1)])
    s = s.select("ts_id", "_n", F.explode(rows).alias("r")).select("ts_id", "_n", "r.lag", "r.acf")
    w = Window.partitionBy("ts_id").orderBy(F.desc(F.abs("acf")), "lag")
    return s.where(F.abs("acf") > z / F.sqrt("_n")).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).drop("_n")


def forecast_errors(df: DataFrame, y: str, p: str) -> DataFrame:
    """MSE, RMSE, MAE, MAPE over non-zero values, sMAPE, R squared, Theil's U against the value before."""
    e, before = F.col(y) - F.col(p), lag(y)
    df = df.withColumns({"_e": e, "_naive": F.col(y) - before})
    both = F.abs(F.col(y)) + F.abs(F.col(p))
    s = df.groupBy("ts_id").agg(
        F.avg(F.col("_e") ** 2).alias("mse"), F.avg(F.abs("_e")).alias("mae"), (100 * F.avg(F.when(F.col(y) != 0, F.abs(F.col("_e") / F.col(y))))).alias("mape"),
        (100 * F.avg(F.when(both > 0, 2 * F.abs("_e") / both).otherwise(0.0))).alias("smape"), F.var_pop(y).alias("_v"),
        F.sum(F.when(F.col("_naive").isNotNull(), F.col("_e") ** 2)).alias("_se"), F.sum(F.col("_naive") ** 2).alias("_sn"),
    )
    return s.select(
        "ts_id", "mse", F.sqrt("mse").alias("rmse"), "mae", F.coalesce("mape", F.lit(100.0)).alias("mape"), "smape",
        F.when(F.col("_v") > 0, 1 - F.col("mse") / F.col("_v")).otherwise(0.0).alias("r2"), F.sqrt(ratio(F.col("_se"), F.col("_sn"))).alias("theils_u"),
    )


def component_shares(df: DataFrame) -> DataFrame:
    """Shares of variance, and seasonal and trend strengths, of ``y, trend, seasonal, residual``."""
    s = df.groupBy("ts_id").agg(
        *[F.var_pop(x).alias(f"v_{x}") for x in ("trend", "seasonal", "residual")],
        F.var_pop(F.col("seasonal") + F.col("residual")).alias("v_sr"), F.var_pop(F.col("y") - F.col("seasonal")).alias("v_ds"),
        F.avg(F.abs(F.col("trend") + F.col("seasonal") - F.col("y"))).alias("e"), F.stddev_pop("y").alias("sy"),
    )
    total = F.col("v_trend") + F.col("v_seasonal") + F.col("v_residual")
    share = {x: F.when(total > 0, F.col(f"v_{x}") / total).otherwise(0.0) for x in ("trend", "seasonal", "residual")}
    error = F.when(F.col("sy") > 0, F.col("e") / F.col("sy")).otherwise(0.0)
    quality = clip((share["trend"] + share["seasonal"]) * (1 - 0.5 * share["residual"]) * (1 - F.least(F.lit(1.0), error)))
    strength = lambda num, den: F.greatest(F.lit(0.0), 1 - ratio(F.col(num), F.col(den)))
    return s.select(
        "ts_id", *[v.alias(f"{x}_share") for x, v in share.items()], strength("v_residual", "v_sr").alias("seasonal_strength"), strength("v_residual", "v_ds").alias("trend_strength"),
        error.alias("reconstruction_error"), quality.alias("quality"),
    )


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation of average ranks."""
    rank = lambda c: F.rank().over(Window.partitionBy("ts_id").orderBy(c)) + (F.count(F.lit(1)).over(Window.partitionBy("ts_id", c)) - 1) / 2
    return df.select("ts_id", rank(x).alias("_a"), rank(y).alias("_b")).groupBy("ts_id").agg(F.corr("_a", "_b").alias("rho"))


def detrend(df: DataFrame, c: str) -> DataFrame:
    """What a line by row number leaves."""
    df = df.withColumn("_i", (F.row_number().over(by_time()) - 1).cast("double"))
    line = df.groupBy("ts_id").agg(F.regr_slope(F.col(c), F.col("_i")).alias("_b"), F.regr_intercept(F.col(c), F.col("_i")).alias("_a"))
    return df.join(line, "ts_id").withColumn("detrended", F.col(c) - F.col("_a") - F.col("_b") * F.col("_i")).drop("_i", "_a", "_b")
