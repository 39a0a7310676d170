"""The chain of stages over many series, and the outlier tiers and scalar rules, as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import scalars as H
from tidegauge.operators import analysis as A
from tidegauge.operators import calendar as C
from tidegauge.operators import outliers as L
from tidegauge.operators import stats as S
from tidegauge.plans.features import BASE, O, base
from tidegauge.plans.registry import query
from tidegauge.plans.relational import rounded
from tidegauge.plans.series import filled
from tidegauge.plans.statistics import _COMP, _MASK, _V, _components
from tidegauge.sources import snapshots
from tidegauge.sources import tables as T


def properties(df: DataFrame, value: str = "y") -> DataFrame:
    """Analyzer, periodicity and data quality of every series: one row each."""
    out = S.basic(df, value).join(S.trend_and_noise(df, value), "ts_id")
    masks = S.outlier_summary(S.consensus(S.outlier_masks(df, value)))
    tests = A.analyse(df, value, "stationarity").select("ts_id", "adf_p", "kpss_p", F.coalesce("is_stationary", F.lit(False)).alias("is_stationary"))
    periods = A.analyse(df, value, "periodicity").select("ts_id", F.coalesce("period", F.lit(0)).alias("period"), F.col("confidence").alias("period_confidence"), "detection")
    out = out.join(masks, "ts_id").join(tests, "ts_id").join(periods, "ts_id")
    quality = S.data_quality(F.col("missing_ratio"), F.col("outlier_ratio"), F.col("noise_level"), F.col("is_stationary"))
    return out.withColumns({"data_quality": quality, "length_class": H.length_class(F.col("length"))})


def preprocess(df: DataFrame, value: str = "y", method: str | None = None) -> DataFrame:
    """Analyzer, decomposition and outlier tiers: every row with masks, components, scores and a robust value."""
    props = properties(df, value).select("ts_id", "data_quality")
    parts = A.decompose(df, value, method, None)
    rows = S.outlier_masks(df.select("ts_id", "open_time", F.col(value).alias("y")), "y").join(parts.drop("message"), ["ts_id", "open_time"])
    shares = S.component_shares(rows)
    rows = L.component_anomalies(L.tier1(rows.join(props, "ts_id"), F.col("data_quality")), shares)
    rows = rows.join(shares.select("ts_id", "residual_share", F.col("quality").alias("_q")), "ts_id")
    rows = L.mixture(rows, F.col("_q"), F.col("residual_share"), F.col("data_quality")).drop("_q", "residual_share")
    return L.price_robust(rows, "y", "outlier")


@query("s01_properties")
def s01(spark, d):
    return properties(filled(spark, d))


@query("s02_preprocess")
def s02(spark, d):
    return preprocess(filled(spark, d), method="stl")


@query("l01_tier1", f"with {_MASK} select ts_id, open_time, is_zscore_outlier::int + is_iqr_outlier::int + is_mad_outlier::int >= 2 tier1, round((0.7 * is_zscore_outlier::int + 0.9 * is_mad_outlier::int + 0.8 * is_iqr_outlier::int) / 2.4 * (0.5 + 0.5 * 0.9), 9) tier1_strength from m")
def l01(spark, d):
    t = L.tier1(S.outlier_masks(base(spark, d), "y"), F.lit(0.9))
    return rounded(t.select("ts_id", "open_time", "tier1", "tier1_strength"), "tier1_strength")


_ANOM = f"""{_COMP}, sh as (select ts_id, var_pop(trend) / {_V} ts, var_pop(seasonal) / {_V} ss, var_pop(residual) / {_V} rs, median(seasonal) ms, median(residual) mr, kurtosis(seasonal) k, mad(seasonal) ams, mad(residual) amr,
  avg(residual) mu, stddev_samp(residual) sd, quantile_cont(residual, 0.25) q1, quantile_cont(residual, 0.75) q3 from c group by 1),
d0 as (select *, abs(coalesce(trend - lag(trend) over ({O}), 0)) dd from c), pp as (select ts_id, quantile_cont(dd, 0.95) p from d0 group by 1),
a as (select d0.ts_id, open_time, dd > p * greatest(0.5, least(1.5, 1 / (1 + ts))) and p >= 1e-10 trend_anomaly,
  ams >= 1e-10 and abs(seasonal - ms) / (case when k > 3.5 then 0.7979 else 0.6745 end * ams) > 3.5 * greatest(0.5, least(1.5, 1 / (1 + ss))) seasonal_anomaly,
  0.5 * (abs(residual - mr) / (0.6745 * amr) > 3.5 * greatest(0.5, least(1.5, 1 / (1 + rs))))::int + 0.3 * (abs(residual - mu) / sd > 3.5 * greatest(0.5, least(1.5, 1 / (1 + rs))))::int
  + 0.2 * (greatest(q1 - residual, residual - q3, 0) / (q3 - q1) > 1.5 * greatest(0.5, least(1.5, 1 / (1 + rs))))::int residual_score from d0 join sh using (ts_id) join pp using (ts_id))"""


@query("l02_component_anomalies", f"with {_ANOM} select ts_id, open_time, trend_anomaly, seasonal_anomaly, round(residual_score, 9) residual_score, residual_score > 0.6 residual_anomaly from a")
def l02(spark, d):
    c = _components(spark, d)
    a = L.component_anomalies(c, S.component_shares(c))
    return rounded(a.select("ts_id", "open_time", "trend_anomaly", "seasonal_anomaly", "residual_score", "residual_anomaly"), "residual_score")


@query("l11_simple", f"with {BASE}, s as (select ts_id, avg(y) m, stddev_samp(y) sd from x group by 1) select ts_id, open_time, abs(y - m) / sd > 3 is_outlier from x join s using (ts_id)")
def l11(spark, d):
    return L.simple(base(spark, d), "y").drop("y")


@query("l16_contamination", f"with {BASE}, s as (select ts_id, quantile_cont(y, 0.25) q1, quantile_cont(y, 0.75) q3 from x group by 1) select ts_id, round(avg((y < q1 - 1.5 * (q3 - q1) or y > q3 + 1.5 * (q3 - q1))::int), 9) contamination from x join s using (ts_id) group by 1")
def l16(spark, d):
    return rounded(L.contamination(base(spark, d), "y"), "contamination")


@query("l19_ratio_cap", f"with {BASE}, s as (select ts_id, median(y) m, count(*) n from x group by 1), f as (select ts_id, open_time, y > 50 hit, abs(y - m) dev, n from x join s using (ts_id)) select ts_id, open_time, hit and row_number() over (partition by ts_id, hit order by dev desc, open_time) <= floor(n * 0.1) hit from f")
def l19(spark, d):
    return L.cap_ratio(base(spark, d).withColumn("hit", F.col("y") > 50), "y", "hit", 0.1).select("ts_id", "open_time", "hit")


@query("f17_price_robust", f"with {BASE}, i as (select *, row_number() over ({O}) i, case when not hour(open_time) % 7 = 0 then y end v from x), w as (select *, last_value(v ignore nulls) over b v0, last_value(case when v is not null then i end ignore nulls) over b i0, first_value(v ignore nulls) over a v1, first_value(case when v is not null then i end ignore nulls) over a i1 from i window b as ({O} rows between unbounded preceding and current row), a as ({O} rows between current row and unbounded following)) select ts_id, open_time, round(coalesce(v, v0 + (v1 - v0) * (i - i0) / nullif(i1 - i0, 0), v0, v1), 9) price_robust from w")
def f17(spark, d):
    b = base(spark, d).withColumn("hit", F.hour("open_time") % 7 == 0)
    return rounded(L.price_robust(b, "y", "hit").select("ts_id", "open_time", "price_robust"), "price_robust")


@query("h10_classes", f"with {BASE} select ts_id, case when count(*) < 20 then 'TINY' when count(*) < 100 then 'SHORT' when count(*) < 500 then 'SMALL' when count(*) < 2000 then 'MEDIUM' when count(*) < 10000 then 'LARGE' when count(*) < 50000 then 'HUGE' else 'MASSIVE' end length_class, 'MEDIUM' frequency_class, count(*) < 168 direct from x group by 1")
def h10(spark, d):
    n = base(spark, d).groupBy("ts_id").agg(F.count(F.lit(1)).alias("n"))
    code = C.interval_of()
    return n.select("ts_id", H.length_class(F.col("n")).alias("length_class"), H.frequency_class(code).alias("frequency_class"), H.direct_method(F.col("n"), code).alias("direct"))


@query("h09_holidays", "select event_id, cast(ts as date) in (date '2024-01-01', date '2024-01-15') is_holiday from events")
def h09(spark, d):
    e = T.table(spark, d, "events").select("event_id", F.to_date("ts").alias("date"))
    days = H.holidays(spark, 2024, 2024).select("date", F.lit(True).alias("hit"))
    return e.join(days, "date", "left").select("event_id", F.coalesce("hit", F.lit(False)).alias("is_holiday"))


@query("h12_wilson", f"with {_MASK}, w as (select ts_id, sum(is_outlier::int) k, count(*)::double n from o group by 1), v as (select *, greatest(n * (1 - 0.2) / (1 + 0.2), 10) m, k / n p from w) select ts_id, round(greatest(0, (p + 1.959964 ** 2 / (2 * m)) / (1 + 1.959964 ** 2 / m) - 1.959964 / (1 + 1.959964 ** 2 / m) * sqrt(p * (1 - p) / m + 1.959964 ** 2 / (4 * m * m))), 9) lo, round(least(1, (p + 1.959964 ** 2 / (2 * m)) / (1 + 1.959964 ** 2 / m) + 1.959964 / (1 + 1.959964 ** 2 / m) * sqrt(p * (1 - p) / m + 1.959964 ** 2 / (4 * m * m))), 9) hi from v")
def h12(spark, d):
    o = S.consensus(S.outlier_masks(base(spark, d), "y")).groupBy("ts_id").agg(F.sum(F.col("is_outlier").cast("int")).alias("k"), F.count(F.lit(1)).cast("double").alias("n"))
    lo, hi = L.wilson(F.col("k"), F.col("n"), F.lit(0.2))
    return rounded(o.select("ts_id", lo.alias("lo"), hi.alias("hi")), "lo", "hi")


@query("h14_staleness", "select event_id, event_id % 10 = 0 or date_diff('day', cast(ts as date), date '2024-02-01') > 14 stale from events")
def h14(spark, d):
    e = T.table(spark, d, "events")
    return e.select("event_id", H.is_stale(F.to_date("ts"), F.lit("2024-02-01").cast("date"), F.lit(14), F.col("event_id") % 10 == 0).alias("stale"))


@query("a18_profile", "select 'event_id' \"column\", 'bigint' \"type\", count(*) n_rows, count(*) - count(event_id) n_null from events union all select 'value', 'double', count(*), count(*) - count(value) from events")
def a18(spark, d):
    return snapshots.profile(T.table(spark, d, "events").select("event_id", "value"))


@query("e15_spearman", f"with {BASE}, p as (select ts_id, y, lag(y) over ({O}) l from x), q as (select * from p where l is not null), r as (select ts_id, rank() over (partition by ts_id order by y) + (count(*) over (partition by ts_id, y) - 1) / 2.0 a, rank() over (partition by ts_id order by l) + (count(*) over (partition by ts_id, l) - 1) / 2.0 b from q) select ts_id, round(corr(a, b), 9) rho from r group by 1")
def e15(spark, d):
    from tidegauge.operators.windows import lag

    return rounded(S.spearman(base(spark, d).withColumn("l", lag("y")).where("l IS NOT NULL"), "y", "l"), "rho")


@query("k18_detrend", f"with {BASE}, n as (select *, row_number() over ({O}) - 1 i from x), s as (select ts_id, regr_slope(y, i) b, regr_intercept(y, i) a from n group by 1) select ts_id, open_time, round(y - a - b * i, 9) detrended from n join s using (ts_id)")
def k18(spark, d):
    return rounded(S.detrend(base(spark, d), "y").select("ts_id", "open_time", "detrended"), "detrended")
