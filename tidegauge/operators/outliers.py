"""Outliers in tiers: votes of masks, anomalies of decomposed components, their adaptive mixture, and robust values.

Input has a row for each time with ``y``, the three masks and ``trend, seasonal, residual``. Quartiles, medians and MADs
are aggregated by series and joined back, a few rows for each series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.calendar import around, line_between
from tidegauge.operators.stats import clip, sample_kurtosis
from tidegauge.operators.windows import by_time, lag

#: Weights of the masks in tier 1, share kept whatever the quality, limits of tier 2.
TIER1 = {"is_zscore_outlier": 0.7, "is_mad_outlier": 0.9, "is_iqr_outlier": 0.8}
ALPHA, MAD_LIMIT, TREND_PERCENTILE, Z_LIMIT, IQR_FACTOR, HEAVY_TAIL = 0.5, 3.5, 0.95, 3.5, 1.5, 3.5
MAD_CONSTANT, HEAVY_CONSTANT = 0.6745, 0.7979
RESIDUAL_WEIGHTS, RESIDUAL_LIMIT = (0.5, 0.3, 0.2), 0.6
COMPONENT_LIMIT, AGREEMENT_FACTOR, STRENGTH_FLOOR = 0.5, 0.8, 0.1
#: Z of a two-sided 95 % interval.
Z95 = 1.959964


def tier1(df: DataFrame, quality: Column) -> DataFrame:
    """Two votes of three; the weighted vote, dampened by data quality."""
    votes = sum(F.col(k).cast("int") for k in TIER1)
    strength = sum(F.col(k).cast("int") * w for k, w in TIER1.items()) / sum(TIER1.values())
    return df.withColumns({"tier1": votes >= 2, "tier1_strength": strength * (ALPHA + (1 - ALPHA) * clip(quality, 0.1, 1.0))})


def scale_of(strength: Column) -> Column:
    return clip(1 / (1 + strength), 0.5, 1.5)


def component_anomalies(df: DataFrame, strengths: DataFrame) -> DataFrame:
    """Anomalies of each component with confidences; ``strengths`` has trend_share, seasonal_share, residual_share."""
    df = df.withColumn("_d", F.abs(F.coalesce(F.col("trend") - lag("trend"), F.lit(0.0))))
    s = df.groupBy("ts_id").agg(
        F.percentile("_d", F.lit(TREND_PERCENTILE)).alias("_p"), F.median("seasonal").alias("_ms"), F.median("residual").alias("_mr"), sample_kurtosis("seasonal").alias("_k"),
        F.avg("residual").alias("_mu"), F.stddev("residual").alias("_sd"), F.percentile("residual", F.array(F.lit(0.25), F.lit(0.75))).alias("_q"),
    )
    df = df.join(s, "ts_id")
    m = df.groupBy("ts_id").agg(F.median(F.abs(F.col("seasonal") - F.col("_ms"))).alias("_as"), F.median(F.abs(F.col("residual") - F.col("_mr"))).alias("_ar"))
    df = df.join(m, "ts_id").join(strengths.select("ts_id", "trend_share", "seasonal_share", "residual_share"), "ts_id")

    def flag(value: Column, limit: Column, fine: Column) -> tuple[Column, Column]:
        hit = fine & (value > limit)
        return hit, F.when(hit, clip(value / limit)).otherwise(0.0)

    trend = flag(F.col("_d"), F.col("_p") * scale_of(F.col("trend_share")), F.col("_p") >= 1e-10)
    constant = F.when(F.col("_k") > HEAVY_TAIL, HEAVY_CONSTANT).otherwise(MAD_CONSTANT)
    seasonal = flag(F.abs(F.col("seasonal") - F.col("_ms")) / (constant * F.col("_as")), MAD_LIMIT * scale_of(F.col("seasonal_share")), F.col("_as") >= 1e-10)
    scale = scale_of(F.col("residual_share"))
    by_mad = flag(F.abs(F.col("residual") - F.col("_mr")) / (MAD_CONSTANT * F.col("_ar")), MAD_LIMIT * scale, F.col("_ar") >= 1e-10)
    by_z = flag(F.abs(F.col("residual") - F.col("_mu")) / F.col("_sd"), Z_LIMIT * scale, F.col("_sd") >= 1e-10)
    width = F.col("_q")[1] - F.col("_q")[0]
    beyond = F.greatest(F.col("_q")[0] - F.col("residual"), F.col("residual") - F.col("_q")[1], F.lit(0.0)) / width
    by_iqr = flag(beyond, IQR_FACTOR * scale, width >= 1e-10)
    off = lambda x: F.coalesce(x, F.lit(False))
    score = sum(off(h).cast("int") * w for (h, _), w in zip((by_mad, by_z, by_iqr), RESIDUAL_WEIGHTS, strict=True))
    df = df.withColumns({
        "trend_anomaly": off(trend[0]), "trend_confidence": F.coalesce(trend[1], F.lit(0.0)), "seasonal_anomaly": off(seasonal[0]), "seasonal_confidence": F.coalesce(seasonal[1], F.lit(0.0)),
        "residual_score": score, "residual_anomaly": score > RESIDUAL_LIMIT,
    })
    weights = {c: F.greatest(F.col(f"{c}_share"), F.lit(STRENGTH_FLOOR)) for c in ("trend", "seasonal", "residual")}
    total = sum(weights.values())
    mixed = (weights["trend"] * F.col("trend_confidence") + weights["seasonal"] * F.col("seasonal_confidence") + weights["residual"] * F.col("residual_score")) / total
    fired = sum(F.col(f"{c}_anomaly").cast("int") for c in weights)
    limit = F.when(fired >= 2, COMPONENT_LIMIT * AGREEMENT_FACTOR).otherwise(COMPONENT_LIMIT)
    df = df.withColumns({"tier2_confidence": mixed, "tier2": (fired > 0) & (mixed > limit)})
    return df.drop("_d", "_p", "_ms", "_mr", "_k", "_mu", "_sd", "_q", "_as", "_ar", "trend_share", "seasonal_share", "residual_share")


def adaptive_weights(quality: Column, residual: Column) -> tuple[Column, Column]:
    """Shares of the tiers: the first alone for poor decompositions, the second ahead for good ones with strong residuals."""
    w1 = F.when(quality < 0.5, 1.0).when((quality >= 0.7) & (residual >= 0.05), 0.3).when(residual < 0.02, 0.6).otherwise(0.5)
    return w1, 1 - w1


def mixture(df: DataFrame, quality: Column, residual: Column, data_quality: Column) -> DataFrame:
    """The tiers' weighted score, the outliers over 0.5, their type, and the score by data quality."""
    w1, w2 = adaptive_weights(quality, residual)
    score = w1 * F.col("tier1_strength") + w2 * F.col("tier2_confidence")
    kind = F.when(~F.col("outlier"), "none").when(F.col("tier1") & F.col("tier2"), "consensus").when(F.col("tier1"), "statistical").otherwise("component")
    df = df.withColumns({"outlier_score": score, "outlier": score > 0.5})
    return df.withColumns({"outlier_type": kind, "outlier_score_enhanced": score * data_quality})


def tiered(df: DataFrame, stop: float = 0.95) -> DataFrame:
    """Tier 1 alone decides where its flagged rows are strong on the whole; else both tiers."""
    mean = F.avg(F.when(F.col("tier1"), F.col("tier1_strength"))).over(Window.partitionBy("ts_id"))
    return df.withColumn("is_outlier", F.when(mean > stop, F.col("tier1")).otherwise(F.col("tier1") | F.col("tier2")))


def simple(df: DataFrame, c: str, limit: float = 3.0) -> DataFrame:
    s = df.groupBy("ts_id").agg(F.avg(c).alias("_m"), F.stddev(c).alias("_s"))
    z = F.abs(F.col(c) - F.col("_m")) / F.col("_s")
    return df.join(s, "ts_id").withColumn("is_outlier", F.coalesce((F.col("_s") > 0) & (z > limit), F.lit(False))).drop("_m", "_s")


def wilson(k: Column, n: Column, acf1: Column) -> tuple[Column, Column]:
    """Interval of a share with the number of rows cut for autocorrelation, ten at least."""
    rho = clip(acf1, -0.95, 0.95)
    m = F.greatest(n * (1 - rho) / (1 + rho), F.lit(10.0))
    p = k / n
    centre = (p + Z95**2 / (2 * m)) / (1 + Z95**2 / m)
    half = Z95 / (1 + Z95**2 / m) * F.sqrt(p * (1 - p) / m + Z95**2 / (4 * m * m))
    return clip(centre - half), clip(centre + half)


def price_robust(df: DataFrame, c: str, mask: str) -> DataFrame:
    """Values at outliers from the line between their neighbours by row, the nearest known value at the ends."""
    df = df.withColumn("_i", F.row_number().over(by_time())).withColumn("_v", F.when(~F.col(mask), F.col(c)))
    before, after = around(F.when(F.col("_v").isNotNull(), F.struct(F.col("_v").alias("v"), F.col("_i").alias("i"))), "open_time")
    df = df.withColumns({"_0": before, "_1": after})
    line = line_between(F.col("_0"), F.col("_1"), F.col("_i"))
    return df.withColumn("price_robust", F.coalesce(F.col("_v"), line, F.col("_0")["v"], F.col("_1")["v"])).drop("_i", "_v", "_0", "_1")


def cap_ratio(df: DataFrame, c: str, mask: str, most: float = 0.3) -> DataFrame:
    """At most a share of a series' rows stay outliers: the ones farthest from the median."""
    s = df.groupBy("ts_id").agg(F.median(c).alias("_m"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("ts_id", mask).orderBy(F.desc(F.abs(F.col(c) - F.col("_m"))), "open_time")
    df = df.join(s, "ts_id").withColumn("_r", F.row_number().over(w))
    return df.withColumn(mask, F.col(mask) & (F.col("_r") <= F.floor(F.col("_n") * most))).drop("_m", "_n", "_r")


def contamination(df: DataFrame, c: str, factor: float = 1.5) -> DataFrame:
    """Share of rows outside the interquartile fence."""
    q = df.groupBy("ts_id").agg(F.percentile(c, F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    width = F.col("q")[1] - F.col("q")[0]
    out = (F.col(c) < F.col("q")[0] - factor * width) | (F.col(c) > F.col("q")[1] + factor * width)
    return df.join(q, "ts_id").groupBy("ts_id").agg(F.avg(out.cast("int")).alias("contamination"))


def cleaned(df: DataFrame, c: str, mask: str, replacement: str) -> DataFrame:
    """Replacement at outliers; nulls stay null."""
    return df.withColumn("cleaned", F.when(F.col(c).isNull(), None).when(F.col(mask), F.col(replacement)).otherwise(F.col(c)))
