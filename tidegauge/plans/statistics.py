"""Statistics, masks, forecast scores and catalogue queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidegauge.operators import catalog as K
from tidegauge.operators import stats as S
from tidegauge.operators import windows as W
from tidegauge.plans.features import BASE, O, base
from tidegauge.plans.registry import query
from tidegauge.plans.relational import rounded
from tidegauge.sources import tables as T


def _per(name, columns, src=BASE, frm="x", rest=""):
    return query(name, f"with {src} select ts_id, " + ", ".join(f'{v} "{k}"' for k, v in columns.items()) + f" from {frm} group by ts_id {rest}")


def _r(x):
    return f"round({x}, 9)"


@_per("e01_aggregates", {"n": "cast(count(*) as bigint)", "lo": _r("min(y)"), "hi": _r("max(y)"), "total": _r("sum(y)")})
def e01(spark, d):
    s = base(spark, d).groupBy("ts_id").agg(F.count(F.lit(1)).alias("n"), F.min("y").alias("lo"), F.max("y").alias("hi"), F.sum("y").alias("total"))
    return rounded(s, "lo", "hi", "total")


_BASIC = {k: _r(f"coalesce({v}, 0)") for k, v in {
    "mean": "avg(y)", "std": "stddev_samp(y)", "min": "min(y)", "max": "max(y)", "skewness": "skewness(y)", "kurtosis": "kurtosis(y)",
    "q1": "quantile_cont(y, 0.25)", "median": "median(y)", "q3": "quantile_cont(y, 0.75)", "iqr": "quantile_cont(y, 0.75) - quantile_cont(y, 0.25)"}.items()}


@_per("e02_basic_stats", {"length": "cast(count(*) as bigint)", "missing_values": "cast(count(*) - count(y) as bigint)", "missing_ratio": _r("1 - count(y) / count(*)")} | _BASIC)
def e02(spark, d):
    return rounded(S.basic(base(spark, d), "y"), "missing_ratio", *_BASIC)


_TN = f"{BASE}, t as (select *, row_number() over ({O}) - 1 i, y - 2 * lag(y, 1) over ({O}) + lag(y, 2) over ({O}) d from x)"


@_per("e03_volatility_trend_noise", {
    "volatility": _r("stddev_samp(y) / abs(avg(y))"), "trend_strength": _r("least(1, greatest(0, least(1, 100 * abs(regr_slope(y, i)) / (abs(avg(y)) + 1e-10)) * regr_r2(y, i)))"),
    "noise_level": _r("least(1, greatest(0, stddev_samp(d) / stddev_samp(y)))")}, _TN, "t")
def e03(spark, d):
    return rounded(S.trend_and_noise(base(spark, d), "y"), "volatility", "trend_strength", "noise_level")


_RT = f"{BASE}, t as (select *, y / nullif(lag(y) over ({O}), 0) - 1 r from x)"


@_per("e06_return_stats", {"returns_mean": _r("avg(r)"), "returns_volatility": _r("stddev_samp(r)"), "returns_count": "cast(count(r) as bigint)"}, _RT, "t")
def e06(spark, d):
    return rounded(S.return_stats(base(spark, d), "y"), "returns_mean", "returns_volatility")


@_per("e07_mad", {"median": _r("median(y)"), "mad": _r("mad(y)")})
def e07(spark, d):
    return rounded(S.mad(base(spark, d), "y"), "median", "mad")


_ENT = f"{BASE}, s as (select ts_id, min(y) lo, max(y) hi, count(y) n from x group by 1), b as (select ts_id, least(floor((y - lo) / (hi - lo) * 20), 19) b, n, count(*) k from x join s using (ts_id) group by all)"


@_per("e08_entropy", {"entropy": _r("-sum(k / n::double * ln(k / n::double))")}, _ENT, "b")
def e08(spark, d):
    return rounded(S.histogram_entropy(base(spark, d), "y", 20), "entropy")


_MASK = f"""{BASE}, s as (select ts_id, median(y) med, mad(y) mad, quantile_cont(y, 0.25) q1, quantile_cont(y, 0.75) q3 from x group by 1),
m as (select ts_id, open_time, y, 0.6745 * abs(y - med) / mad > 3.5 is_zscore_outlier, y < q1 - 1.3 * (q3 - q1) or y > q3 + 1.3 * (q3 - q1) is_iqr_outlier, 0.6745 * abs(y - med) / mad > 3.5 is_mad_outlier from x join s using (ts_id)),
c as (select *, 0.5 * is_mad_outlier::int + 0.3 * is_iqr_outlier::int + 0.2 * is_zscore_outlier::int score from m), o as (select *, score >= 0.5 is_outlier, row_number() over ({O}) i from c)"""


@query("i08_outlier_masks", f"with {_MASK} select ts_id, open_time, is_zscore_outlier, is_iqr_outlier, is_mad_outlier from m")
def i08(spark, d):
    return S.outlier_masks(base(spark, d), "y").drop("y")


@query("i11_consensus", f"with {_MASK} select ts_id, open_time, round(score, 9) consensus_score, is_outlier, is_zscore_outlier::int + is_iqr_outlier::int + is_mad_outlier::int >= 2 is_outlier_votes from o")
def i11(spark, d):
    c = S.consensus(S.outlier_masks(base(spark, d), "y"))
    return rounded(c.select("ts_id", "open_time", "consensus_score", "is_outlier", "is_outlier_votes"), "consensus_score")


@_per("i11_outlier_summary", {
    "n_outliers": "cast(sum(is_outlier::int) as bigint)", "outlier_ratio": _r("sum(is_outlier::int) / count(*)"),
    "agreement": _r("coalesce(sum(is_outlier::int) / nullif(greatest(sum(is_mad_outlier::int), sum(is_iqr_outlier::int), sum(is_zscore_outlier::int)), 0), 0)")}, _MASK, "o")
def i11s(spark, d):
    return rounded(S.outlier_summary(S.consensus(S.outlier_masks(base(spark, d), "y"))), "outlier_ratio", "agreement")


_OS = f"{_MASK}, nrm as (select ts_id, var_samp(y) vn, median(y) mn from o where not is_outlier group by 1), h as (select o.*, vn, mn, i - lag(i) over ({O}) gap from o join nrm using (ts_id) where is_outlier)"


@_per("e12_outlier_statistics", {"variance_ratio": _r("var_samp(y) / any_value(vn)"), "mean_distance": _r("avg(abs(y - mn))"), "gap_std": _r("stddev_pop(gap)")}, _OS, "h")
def e12(spark, d):
    return rounded(S.outlier_statistics(S.consensus(S.outlier_masks(base(spark, d), "y")), "y"), "variance_ratio", "mean_distance", "gap_std")


@query("e16_mask_independence", f"with {_MASK}, p as (select ts_id, corr(is_iqr_outlier::int, is_mad_outlier::int) r1, corr(is_iqr_outlier::int, is_zscore_outlier::int) r2, corr(is_mad_outlier::int, is_zscore_outlier::int) r3 from o group by 1) select ts_id, 'is_iqr_outlier' a, 'is_mad_outlier' b, round(r1, 9) r, abs(r1) > 0.7 dependent from p union all select ts_id, 'is_iqr_outlier', 'is_zscore_outlier', round(r2, 9), abs(r2) > 0.7 from p union all select ts_id, 'is_mad_outlier', 'is_zscore_outlier', round(r3, 9), abs(r3) > 0.7 from p")
def e16(spark, d):
    return rounded(S.mask_independence(S.outlier_masks(base(spark, d), "y")), "r")


_PRED = f"{BASE}, p as (select *, avg(y) over ({O} rows between 3 preceding and 1 preceding) p from x), q as (select *, y - lag(y) over ({O}) nv from p where p is not null)"


@_per("e17_forecast_errors", {
    "mse": _r("avg((y - p) ** 2)"), "rmse": _r("sqrt(avg((y - p) ** 2))"), "mae": _r("avg(abs(y - p))"), "mape": _r("100 * avg(case when y <> 0 then abs((y - p) / y) end)"),
    "smape": _r("100 * avg(case when abs(y) + abs(p) > 0 then 2 * abs(y - p) / (abs(y) + abs(p)) else 0 end)"), "r2": _r("1 - avg((y - p) ** 2) / var_pop(y)"),
    "theils_u": _r("sqrt(sum(case when nv is not null then (y - p) ** 2 end) / sum(nv ** 2))")}, _PRED, "q")
def e17(spark, d):
    b = base(spark, d).withColumn("p", F.avg("y").over(W.by_time().rowsBetween(-3, -1))).where("p IS NOT NULL")
    return rounded(S.forecast_errors(b, "y", "p"), "mse", "rmse", "mae", "mape", "smape", "r2", "theils_u")


_COMP = f"""{BASE}, t as (select *, avg(y) over ({O} rows between 12 preceding and 11 following) trend from x), g as (select *, avg(y - trend) over (partition by ts_id, hour(open_time)) seasonal from t), c as (select *, y - trend - seasonal residual from g)"""


def _components(spark, d):
    from pyspark.sql import Window

    b = base(spark, d).withColumn("trend", F.avg("y").over(W.by_time().rowsBetween(-12, 11)))
    b = b.withColumn("seasonal", F.avg(F.col("y") - F.col("trend")).over(Window.partitionBy("ts_id", F.hour("open_time"))))
    return b.withColumn("residual", F.col("y") - F.col("trend") - F.col("seasonal"))


_V = "(var_pop(trend) + var_pop(seasonal) + var_pop(residual))"
_E = "avg(abs(trend + seasonal - y)) / stddev_pop(y)"


@_per("e19_component_shares", {
    "trend_share": _r(f"var_pop(trend) / {_V}"), "seasonal_share": _r(f"var_pop(seasonal) / {_V}"), "residual_share": _r(f"var_pop(residual) / {_V}"),
    "seasonal_strength": _r("greatest(0, 1 - var_pop(residual) / var_pop(seasonal + residual))"), "trend_strength": _r("greatest(0, 1 - var_pop(residual) / var_pop(y - seasonal))"),
    "reconstruction_error": _r(_E), "quality": _r(f"least(1, greatest(0, (var_pop(trend) + var_pop(seasonal)) / {_V} * (1 - 0.5 * var_pop(residual) / {_V}) * (1 - least(1, {_E}))))")}, _COMP, "c")
def e19(spark, d):
    s = S.component_shares(_components(spark, d))
    return rounded(s, *[c for c in s.columns if c != "ts_id"])


@query("k19_classical_decomposition", f"with {_COMP} select ts_id, open_time, round(trend, 9) trend, round(seasonal, 9) seasonal, round(residual, 9) residual from c")
def k19(spark, d):
    return rounded(_components(spark, d).drop("y"), "trend", "seasonal", "residual")


_ACF = f"{BASE}, s as (select ts_id, avg(y) m, count(y) n, var_pop(y) v from x group by 1), z as (select x.ts_id, open_time, y - m x, n, v from x join s using (ts_id)), " + "a as (" + " union all ".join(f"select ts_id, n, {k} lag, sum(p) / ((n - {k}) * v) acf from (select ts_id, n, v, x * lag(x, {k}) over ({O}) p from z) group by ts_id, n, v" for k in range(1, 25)) + ")"


@query("i06_significant_lags", f"with {_ACF} select ts_id, cast(lag as int) lag, round(acf, 9) acf, cast(row_number() over (partition by ts_id order by abs(acf) desc, lag) as int) rank from a where abs(acf) > 1.96 / sqrt(n) qualify row_number() over (partition by ts_id order by abs(acf) desc, lag) <= 10")
def i06(spark, d):
    return rounded(S.significant_lags(base(spark, d), "y", 24, 10), "acf")


@query("o01_expanding_folds", f"with {BASE}, n as (select *, row_number() over ({O}) - 1 i, count(*) over (partition by ts_id) n from x), f as (select *, n // 5 t, unnest([1, 2, 3, 4]) fold from n), r as (select *, n - (5 - fold) * t a from f) select ts_id, cast(fold as int) fold, case when i < a then 'train' else 'test' end role, cast(count(*) as bigint) k from r where i < a + t group by all")
def o01(spark, d):
    return K.folds(base(spark, d), 4).groupBy("ts_id", "fold", "role").agg(F.count(F.lit(1)).alias("k"))


@query("o01_rolling_folds", f"with {BASE}, n as (select *, row_number() over ({O}) - 1 i, count(*) over (partition by ts_id) n from x), f as (select *, n // 5 t, unnest([1, 2, 3, 4]) fold from n), r as (select *, n - (5 - fold) * t a from f) select ts_id, cast(fold as int) fold, case when i < a then 'train' else 'test' end role, cast(count(*) as bigint) k from r where i < a + t and i >= a - 100 group by all")
def o01r(spark, d):
    return K.folds(base(spark, d), 4, "rolling", 100).groupBy("ts_id", "fold", "role").agg(F.count(F.lit(1)).alias("k"))


@query("o03_ensemble", f"with {BASE} select ts_id, open_time, round((lag(y, 1) over ({O}) + lag(y, 24) over ({O})) / 2, 9) ensemble from x")
def o03(spark, d):
    b = W.add_lags(base(spark, d), "y", (1, 24))
    return rounded(K.ensemble(b, ["lag_1", "lag_24"]).select("ts_id", "open_time", "ensemble"), "ensemble")


@query("e21_best_model", "with m as (select event_type ts_id, cast(user_id as varchar) model, max(value) score from events group by 1, 2) select ts_id, arg_max(model, (score, model)) model, round(max(score), 9) score from m group by 1")
def e21(spark, d):
    m = T.table(spark, d, "events").groupBy(F.col("event_type").alias("ts_id"), F.col("user_id").cast("string").alias("model")).agg(F.max("value").alias("score"))
    return rounded(K.best_model(m, "score", "model"), "score")


_PROPS = "p as (select 'crypto_'||event_type||'_1h' ts_id, cast(event_id as varchar) property_id, case when event_id % 2 = 0 then 'analyzer' else 'periodicity' end property_group, ts calculated_at, event_id % 7 <> 0 is_active from events)"


def _properties(spark, d):
    e = T.table(spark, d, "events")
    return e.select(
        F.concat(F.lit("crypto_"), "event_type", F.lit("_1h")).alias("ts_id"), F.col("event_id").cast("string").alias("property_id"),
        F.when(F.col("event_id") % 2 == 0, "analyzer").otherwise("periodicity").alias("property_group"), F.col("ts").alias("calculated_at"), (F.col("event_id") % 7 != 0).alias("is_active"),
    )


@query("p01_fresh_properties", f"with {_PROPS} select ts_id, property_id, property_group, calculated_at, is_active from (select * from p where is_active qualify row_number() over (partition by ts_id, property_group order by calculated_at desc, property_id desc) = 1) where date_diff('day', cast(calculated_at as date), date '2024-02-01') <= case property_group when 'analyzer' then 2 else 30 end")
def p01(spark, d):
    age = spark.createDataFrame([("analyzer", 2), ("periodicity", 30)], "property_group string, max_age int")
    return K.fresh_properties(_properties(spark, d), datetime(2024, 2, 1), age)


@query("p02_add_version", f"with {_PROPS}, n as (select distinct ts_id, property_group from p where ts_id = 'crypto_view_1h') select p.ts_id, property_id, p.property_group, calculated_at, is_active and n.ts_id is null is_active from p left join n on n.ts_id = p.ts_id and n.property_group = p.property_group union all select ts_id, 'new-'||property_group, property_group, timestamp '2024-02-01', true from n")
def p02(spark, d):
    p = _properties(spark, d)
    new = p.where("ts_id = 'crypto_view_1h'").select("ts_id", "property_group").distinct()
    new = new.select("ts_id", F.concat(F.lit("new-"), "property_group").alias("property_id"), "property_group", F.lit(datetime(2024, 2, 1)).cast("timestamp_ntz").alias("calculated_at"), F.lit(True).alias("is_active"))
    return K.add_version(p, new)
