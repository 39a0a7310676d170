"""Windowed features of series: lags, rolling statistics, trends, derivatives, returns, scalers.

All windows share one partitioning by ``ts_id`` and one order, so a chain of them shuffles and sorts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lags and rolling windows by interval.
LAGS = {"1h": (1, 12, 24, 168), "12h": (1, 2, 3, 14), "1d": (1, 7, 14, 30), "3d": (1, 2, 7), "1w": (1, 2, 4), "1M": (1, 3, 6, 12)}
WINDOWS = {"1h": (3, 6, 12, 24), "12h": (2, 4, 6, 14), "1d": (3, 7, 14, 30), "3d": (2, 4, 7), "1w": (2, 4, 6), "1M": (3, 6, 12)}
DEFAULT_LAGS, DEFAULT_WINDOWS = (1, 2, 3, 4, 5), (3, 5, 7)
UNRELIABLE_SHARE = 0.15


def by_time():
    return Window.partitionBy("ts_id").orderBy("open_time")


def whole():
    return Window.partitionBy("ts_id")


def rows(n: int):
    return by_time().rowsBetween(-(n - 1), 0)


def lag(c: str, k: int = 1) -> Column:
    return F.lag(c, k).over(by_time())


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.when(b != 0, a / b)


def add_lags(df: DataFrame, c: str, lags) -> DataFrame:
    return df.withColumns({f"lag_{k}": lag(c, k) for k in lags})


def sample_skewness(c: str | Column, w=None) -> Column:
    """Bias-corrected; null under three values, 0 where all are equal."""
    over = (lambda x: x.over(w)) if w is not None else (lambda x: x)
    n, g, s = over(F.count(c)), over(F.skewness(c)), over(F.var_pop(c))
    return F.when(n < 3, None).when(s == 0, 0.0).otherwise(g * F.sqrt((n * (n - 1)).cast("double")) / (n - 2))


def sample_kurtosis(c: str | Column, w=None) -> Column:
    """Bias-corrected excess; null under four values, 0 where all are equal."""
    over = (lambda x: x.over(w)) if w is not None else (lambda x: x)
    n, g, s = over(F.count(c)), over(F.kurtosis(c)), over(F.var_pop(c))
    return F.when(n < 4, None).when(s == 0, 0.0).otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g + 6))


def rolling(df: DataFrame, c: str, sizes) -> DataFrame:
    """Mean, deviation, extremes and median over the last n rows, skewness for n > 2, kurtosis for n > 3."""
    out = {}
    for n in sizes:
        w = rows(n)
        out |= {
            f"roll_mean_{n}": F.avg(c).over(w), f"roll_std_{n}": F.stddev(c).over(w), f"roll_min_{n}": F.min(c).over(w),
            f"roll_max_{n}": F.max(c).over(w), f"roll_median_{n}": F.percentile(c, F.lit(0.5)).over(w),
        }
        if n > 2:
            out[f"roll_skew_{n}"] = sample_skewness(c, w)
        if n > 3:
            out[f"roll_kurtosis_{n}"] = sample_kurtosis(c, w)
    return df.withColumns(out)


def rolling_trend(df: DataFrame, c: str, sizes) -> DataFrame:
    """Slope over each full window; -1 throughout where the window is over 15 % of the series."""
    df = df.withColumn("_i", F.row_number().over(by_time())).withColumn("_n", F.count(F.lit(1)).over(whole()))
    out = {}
    for n in sizes:
        w = rows(n)
        slope = F.when(F.count(c).over(w) == n, F.regr_slope(F.col(c), F.col("_i")).over(w))
        out[f"rolling_trend_{n}"] = F.when(F.lit(n) / F.col("_n") > UNRELIABLE_SHARE, -1.0).otherwise(slope)
    return df.withColumns(out).drop("_i", "_n")


def derivatives(df: DataFrame, c: str) -> DataFrame:
    """Differences over one and over two rows."""
    return df.withColumns({"first_derivative": F.col(c) - lag(c, 1), "second_derivative": F.col(c) - lag(c, 2)})


def returns(df: DataFrame, c: str, name: str = "returns") -> DataFrame:
    return df.withColumn(name, ratio(F.col(c), lag(c)) - 1)


def add_features(df: DataFrame, c: str, code: str, holidays: DataFrame | None = None, drop_incomplete: bool = True) -> DataFrame:
    """The whole feature set of an interval; rows with any null go last."""
    lags, sizes = LAGS.get(code, DEFAULT_LAGS), WINDOWS.get(code, DEFAULT_WINDOWS)
    df = returns(derivatives(rolling_trend(rolling(add_lags(df, c, lags), c, sizes), c, sizes), c), c)
    df = df.withColumn("volatility", F.stddev("returns").over(rows(sizes[len(sizes) // 2])))
    if holidays is not None:
        marked = holidays.select(F.col("date").alias("_date"), F.lit(True).alias("_hit"))
        df = df.join(marked, F.to_date("open_time") == F.col("_date"), "left")
        df = df.withColumn("is_holiday", F.coalesce("_hit", F.lit(False))).drop("_date", "_hit")
    return df.dropna() if drop_incomplete else df


def rolling_median_filter(df: DataFrame, c: str, half: int, threshold: float = 3.0) -> DataFrame:
    """Values over ``threshold`` rolling MADs from the centred rolling median give way to it."""
    w = by_time().rowsBetween(-half, half)
    df = df.withColumn("_median", F.percentile(c, F.lit(0.5)).over(w)).withColumn("_off", F.abs(F.col(c) - F.col("_median")))
    df = df.withColumn("_mad", F.percentile("_off", F.lit(0.5)).over(w))
    clean = F.when((F.col("_mad") > 0) & (F.col("_off") > threshold * F.col("_mad")), F.col("_median")).otherwise(F.col(c))
    return df.withColumn("filtered", clean).drop("_median", "_off", "_mad")


def rolling_correlation(df: DataFrame, x: str, y: str, n: int, floor: float = 1e-8) -> DataFrame:
    w = rows(n)
    good = (F.var_samp(x).over(w) > floor) & (F.var_samp(y).over(w) > floor) & (F.count(F.lit(1)).over(w) == n)
    return df.withColumn("rolling_corr", F.when(good, F.corr(x, y).over(w)))


def overlapping_sums(df: DataFrame, c: str, ks) -> DataFrame:
    return df.withColumns({f"sum_{k}": F.when(F.count(c).over(rows(k)) == k, F.sum(c).over(rows(k))) for k in ks})


def forward_returns(df: DataFrame, c: str, horizons=(1, 5, 10, 20)) -> DataFrame:
    return df.withColumns({f"fwd_{h}": ratio(F.lead(c, h).over(by_time()), F.col(c)) - 1 for h in horizons})


def around(df: DataFrame, c: str, k: int) -> DataFrame:
    """Arrays of the k values before and after each row."""
    before, after = by_time().rowsBetween(-k, -1), by_time().rowsBetween(1, k)
    return df.withColumns({"pre": F.collect_list(c).over(before), "post": F.collect_list(c).over(after)})


def cumulative(df: DataFrame, c: str) -> DataFrame:
    return df.withColumn("cumulative", F.sum(c).over(by_time().rowsBetween(Window.unboundedPreceding, 0)))


def scaler_parameters(df: DataFrame, c: str) -> DataFrame:
    """What the linear scalers need, one row for each series."""
    q = F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    p = df.groupBy("ts_id").agg(F.min(c).alias("lo"), F.max(c).alias("hi"), F.avg(c).alias("mu"), F.stddev_pop(c).alias("sd"), q.alias("q"))
    return p.select("ts_id", "lo", "hi", "mu", "sd", F.col("q")[0].alias("q1"), F.col("q")[1].alias("med"), F.col("q")[2].alias("q3"))


def _scale(method: str) -> tuple[Column, Column]:
    one = F.lit(1.0)
    ranges = {
        "minmax": (F.col("lo"), F.col("hi") - F.col("lo")),
        "standard": (F.col("mu"), F.col("sd")),
        "robust": (F.col("med"), F.col("q3") - F.col("q1")),
    }
    shift, width = ranges[method]
    return shift, F.when(width == 0, one).otherwise(width)


def scale(df: DataFrame, c: str, method: str, parameters: DataFrame | None = None) -> DataFrame:
    """``scaled`` by minmax, standard, robust, log or quantile (normal scores)."""
    if method == "log":
        return df.withColumn("scaled", F.log1p(c))
    if method == "quantile":
        w = Window.partitionBy("ts_id").orderBy(c)
        p = F.least(F.greatest(F.percent_rank().over(w), F.lit(1e-7)), F.lit(1 - 1e-7))
        return df.withColumn("scaled", normal_quantile(p))
    shift, width = _scale(method)
    joined = df.join(parameters if parameters is not None else scaler_parameters(df, c), "ts_id")
    return joined.withColumn("scaled", (F.col(c) - shift) / width).select(*df.columns, "scaled")


def unscale(df: DataFrame, c: str, method: str, parameters: DataFrame) -> DataFrame:
    if method == "log":
        return df.withColumn("unscaled", F.expm1(c))
    shift, width = _scale(method)
    return df.join(parameters, "ts_id").withColumn("unscaled", F.col(c) * width + shift).select(*df.columns, "unscaled")


#: Coefficients of the published rational approximation of the normal distribution's inverse.
NORMAL_MIDDLE = (
    (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00),
    (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01),
)
NORMAL_TAIL = (
    (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00),
    (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00),
)


def normal_quantile(p: Column) -> Column:
    """The normal distribution's inverse by rational approximation (relative error under 1.2e-9), in the JVM."""
    (a, b), (c, d) = NORMAL_MIDDLE, NORMAL_TAIL

    def poly(x: Column, k) -> Column:
        out = F.lit(k[0])
        for v in k[1:]:
            out = out * x + v
        return out

    q = p - 0.5
    r = q * q
    middle = poly(r, a) * q / (poly(r, b) * r + 1)
    low, high = F.sqrt(-2 * F.log(p)), F.sqrt(-2 * F.log1p(-p))
    tail = lambda x: poly(x, c) / (poly(x, d) * x + 1)
    return F.when(p < 0.02425, tail(low)).when(p > 1 - 0.02425, -tail(high)).otherwise(middle)


def train_test(df: DataFrame, c: str, lags: int, share: float = 0.8, fit_on_all: bool = False) -> DataFrame:
    """Lag matrix with min-max scaled value; the first ``share`` of each series is for training.

    The scaler is fitted on the training rows unless ``fit_on_all``.
    """
    df = df.withColumns({f"lag_{k}": lag(c, k) for k in range(1, lags + 1)}).dropna()
    df = df.withColumn("_i", F.row_number().over(by_time())).withColumn("_n", F.count(F.lit(1)).over(whole()))
    df = df.withColumn("is_train", F.col("_i") <= F.floor(F.col("_n") * share)).drop("_i", "_n")
    ends = (df if fit_on_all else df.where("is_train")).groupBy("ts_id").agg(F.min(c).alias("lo"), F.max(c).alias("hi"))
    shift, width = _scale("minmax")
    return df.join(ends, "ts_id").withColumn("scaled", (F.col(c) - shift) / width).drop("lo", "hi")
