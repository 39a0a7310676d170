"""Rules over series, components and scores as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.functions import scalars as H
from tidegauge.operators import calendar as C
from tidegauge.operators import finance as N
from tidegauge.operators import rules as R
from tidegauge.operators import stats as S
from tidegauge.operators.windows import by_time, lag
from tidegauge.plans import registry
from tidegauge.plans.features import BASE, O, base
from tidegauge.plans.finance import _SURE, CLEAN, pairs, t_two_sided_sql
from tidegauge.plans.registry import query
from tidegauge.plans.relational import EVT, ORD, rounded
from tidegauge.plans.series import chi2_sf_sql
from tidegauge.plans.statistics import _COMP, _components
from tidegauge.sources import tables as T

_CLIP = "least(1, greatest(0, {}))"


def _events(spark, d):
    return T.table(spark, d, "events")


def _both(spark, d):
    return T.candles_evt(spark, d).select("ts_id", "open_time").union(T.candles_ord(spark, d).select("ts_id", "open_time"))


_COUNTS = f"{EVT}, {ORD}, n as (select ts_id, count(*) n, split_part(ts_id, '_', 3) code from (select ts_id from candles_evt union all select ts_id from candles_ord) group by 1)"


# --- gates and rows --------------------------------------------------------------------------------------------------


@query("b05_known_columns", f"with {EVT} select ts_id, open_time, round(\"close\", 9) \"close\" from candles_evt")
def b05(spark, d):
    c = T.candles_evt(spark, d).withColumn("helper", F.lit(1))
    known = ("ts_id", "open_time", "close", "absent")
    return rounded(c.select(*[x for x in known if x in c.columns]), "close")


@query("b06_arity", "select o_orderkey, o_orderkey % 5 <> 0 is_valid from orders")
def b06(spark, d):
    fields = F.array(*[F.lit(str(k)) for k in range(12)])
    row = F.slice(fields, 1, F.when(F.col("o_orderkey") % 5 == 0, 11).otherwise(12))
    return T.table(spark, d, "orders").select("o_orderkey", R.has_arity(F.when(F.col("o_orderkey") % 10 != 0, row), 12).alias("is_valid"))


@query("b09_json_safe", "select event_id, case when event_id % 7 > 1 then round(value, 9) end safe from events")
def b09(spark, d):
    odd = F.when(F.col("event_id") % 7 == 0, float("nan")).when(F.col("event_id") % 7 == 1, float("-inf")).otherwise(F.round("value", 9))
    text = F.to_json(F.struct(R.json_safe(odd).alias("v")))
    return _events(spark, d).select("event_id", F.get_json_object(text, "$.v").cast("double").alias("safe"))


@query("b12_property_or_default", "select event_id, coalesce(try_cast(json_extract_string(case when event_id % 3 > 0 then props end, '$.k') as double), -1) k, 0.5::double absent from events")
def b12(spark, d):
    props = F.when(F.col("event_id") % 3 > 0, F.col("props"))
    return _events(spark, d).select("event_id", R.property_or(props, "k", -1).alias("k"), R.property_or(props, "absent", 0.5).alias("absent"))


@query("h08_property_struct", "select event_id, cast(json_extract_string(props, '$.k') as bigint) k from events")
def h08(spark, d):
    return _events(spark, d).select("event_id", F.from_json("props", "k long")["k"].alias("k"))


_GATED = f"{EVT}, x as (select ts_id, open_time, case when ts_id like '%click%' then 1.0 when ts_id like '%view%' and hour(open_time) > 1 then null when ts_id like '%error%' then (open > 20)::int::double when ts_id like '%signup%' and hour(open_time) > 0 then 7.0 else open end y from candles_evt)"


@query("k10_gates", f"""with {_GATED}, p as (select ts_id, y, count(*) n from x group by 1, 2), s as (select ts_id, cast(sum(n) as bigint) n, coalesce(sum(n) filter (y is not null), 0) known, count(y) dis, max(n) filter (y is not null) mode, max(abs(y)) most from p group by 1)
  select ts_id, n, case when n < 10 then 'too short' when 1 - known / n > 0.8 then 'too many missing' when known > 0 and dis < 3 then 'too few distinct values' when mode / known > 0.95 then 'nearly constant' when most > 1e10 then 'values over 1e10' end reason from s""")
def k10(spark, d):
    t, h = F.col("ts_id"), F.hour("open_time")
    y = (
        F.when(t.contains("click"), 1.0).when(t.contains("view") & (h > 1), None).when(t.contains("error"), (F.col("y") > 20).cast("int").cast("double"))
        .when(t.contains("signup") & (h > 0), 7.0).otherwise(F.col("y"))
    )
    return R.gates(base(spark, d).withColumn("y", y), "y")


@query("i14_legacy_counts", f"with {BASE}, h as (select ts_id, case when hour(open_time) % 5 > 0 then y end y from x), s as (select ts_id, avg(y) m, stddev_pop(y) sd from h group by 1) select ts_id, cast(count(*) - count(y) as bigint) missing_values, cast(sum((abs(y - m) / sd > 3)::int) as bigint) outliers from h join s using (ts_id) group by 1")
def i14(spark, d):
    return R.legacy_counts(base(spark, d).withColumn("y", F.when(F.hour("open_time") % 5 > 0, F.col("y"))), "y")


_PAIR = f"{BASE}, a as (select ts_id, open_time, y, row_number() over ({O}) i from x where hour(open_time) < 16), b as (select ts_id, case when ts_id like '%view%' then open_time + interval 30 minute else open_time end open_time, -y z, row_number() over ({O}) i from x where hour(open_time) > 3)"


@query("d10_align_components", f"with {_PAIR}, c as (select ts_id, row_number() over (partition by ts_id order by open_time) i, y, z from a join b using (ts_id, open_time)), p as (select a.ts_id, a.i, y, z from a join b on b.ts_id = a.ts_id and b.i = a.i where a.ts_id not in (select ts_id from c)) select ts_id, cast(i as int) i, round(y, 9) a, round(z, 9) b from c union all select ts_id, cast(i as int), round(y, 9), round(z, 9) from p")
def d10(spark, d):
    x = base(spark, d)
    a = x.where(F.hour("open_time") < 16).withColumnRenamed("y", "value")
    later = F.when(F.col("ts_id").contains("view"), F.col("open_time") + F.expr("INTERVAL 30 MINUTES")).otherwise(F.col("open_time")).cast("timestamp_ntz")
    b = x.where(F.hour("open_time") > 3).select("ts_id", later.alias("open_time"), (-F.col("y")).alias("value"))
    return rounded(R.align_components(a, b), "a", "b")


@query("d02_left_join", f"with {EVT} select g.ts_id, g.open_time, c.close_time from candles_evt g left join (select ts_id, open_time, cast(open_time + interval 3599 second as timestamp) close_time from candles_evt where hour(open_time) % 2 = 0) c using (ts_id, open_time)")
def d02(spark, d):
    c = T.candles_evt(spark, d).select("ts_id", "open_time")
    ends = c.where(F.hour("open_time") % 2 == 0).withColumn("close_time", C.close_time(F.col("open_time"), "1h"))
    return c.join(ends, ["ts_id", "open_time"], "left")


@query("c16_repaired", f"with {EVT} select ts_id, open_time, round(open, 9) open from candles_evt union all select ts_id, open_time, open from ({registry.oracle_of('c14_gap_fill')})")
def c16r(spark, d):
    c = T.candles_evt(spark, d)
    return rounded(C.repaired(c.union(c), "1h").select("ts_id", "open_time", "open"), "open")


# --- components ------------------------------------------------------------------------------------------------------


@query("k11_consistency", f"with {_COMP}, s as (select ts_id, avg(abs(trend + seasonal + 0.99 * residual - y)) / (stddev_pop(y) + 1e-10) e from c group by 1) select ts_id, round(e, 9) error, e <= 0.015 is_valid from s")
def k11(spark, d):
    c = _components(spark, d).withColumn("residual", F.col("residual") * 0.99)
    return rounded(R.consistency(c, "fourier"), "error")


_POST = f"{_COMP}, v as (select ts_id, stddev_samp(y) / abs(avg(y)) vol from x group by 1), s as (select c.ts_id, avg((y - trend - seasonal * 3) ** 2) mse, avg(y - trend - seasonal * 3) sh, var_pop(y) vy, var_pop(seasonal * 3) vs, any_value(vol) vol from c join v using (ts_id) group by 1), f as (select ts_id, case when mse > 0.1 * vy then sh else 0 end sh, case when vol > 0.7 and vs > 0.6 * vy then sqrt(0.6 * vy / vs) * (1 - (vol - 0.7) * 0.5) else 1 end k, mse > 0.1 * vy or (vol > 0.7 and vs > 0.6 * vy) w from s)"


@query("k05_postprocess", f"with {_POST} select ts_id, open_time, round(trend + sh, 8) trend, round(seasonal * 3 * k, 8) seasonal, round(case when w then y - trend - sh - seasonal * 3 * k else residual end, 8) residual from c join f using (ts_id)")
def k05(spark, d):
    c = _components(spark, d).withColumn("seasonal", F.col("seasonal") * 3)
    p = R.postprocess(c, S.trend_and_noise(base(spark, d), "y"))
    return p.select("ts_id", "open_time", *[F.round(x, 8).alias(x) for x in ("trend", "seasonal", "residual")])


_SCORE = "(0.3 / (1 + avg((y - trend - seasonal) ** 2)) + 0.3 / (1 + avg(abs(y - trend - seasonal))) + 0.1 * greatest(0, 1 - var_pop(residual) / var_pop(seasonal + residual)) + 0.1 * greatest(0, 1 - var_pop(residual) / var_pop(y - seasonal)))"


@query("k14_composite", f"with {_COMP} select ts_id, round(least(1, greatest(0, {_SCORE} / 0.8)), 9) composite from c group by 1")
def k14(spark, d):
    c = _components(spark, d)
    miss = F.col("y") - F.col("trend") - F.col("seasonal")
    errors = c.groupBy("ts_id").agg(F.avg(miss * miss).alias("mse"), F.avg(F.abs(miss)).alias("mae"))
    s = errors.join(S.component_shares(c), "ts_id")
    scores = {k: F.col(k) for k in ("mse", "mae", "seasonal_strength", "trend_strength")} | {"aic": F.lit(None).cast("double")}
    return rounded(s.select("ts_id", R.composite(scores).alias("composite")), "composite")


_LBR = f"{_COMP}, rk as (select ts_id, row_number() over ({O}) i, count(*) over (partition by ts_id) n, residual - avg(residual) over (partition by ts_id) z from c), rv as (select ts_id, sum(z * z) v from rk group by 1), rq as (select a.ts_id, any_value(a.n) n, b.i - a.i k, sum(a.z * b.z) s from rk a join rk b on b.ts_id = a.ts_id and b.i - a.i between 1 and least(10, a.n // 5) group by 1, 3), rs as (select ts_id, cast(max(k) as int) lags, any_value(n) * (any_value(n) + 2) * sum(pow(s / v, 2) / (n - k)) q from rq join rv using (ts_id) group by 1), rp as (select ts_id, lags, q, {chi2_sf_sql('q', 'lags')} p from rs)"


@query("l07_independence", f"with {_LBR} select ts_id, lags, round(q, 7) statistic, round(p, 6) p_value, p > 0.05 is_independent from rp")
def l07(spark, d):
    got = R.independence(_components(spark, d), "residual")
    return got.select("ts_id", "lags", F.round("statistic", 7).alias("statistic"), F.round("p_value", 6).alias("p_value"), "is_independent")


# --- periods and methods ---------------------------------------------------------------------------------------------


@query("j11_period_quality", "select event_id, round(least(1, greatest(0, least(1, abs(value) / 100) * (1 + 0.1 * least(event_id % 8, 5)))), 9) quality from events")
def j11(spark, d):
    q = R.period_quality(F.least(F.lit(1.0), F.abs("value") / 100), F.col("event_id") % 8)
    return rounded(_events(spark, d).select("event_id", q.alias("quality")), "quality")


_LENGTH = "case when n < 20 then 'TINY' when n < 100 then 'SHORT' else 'MORE' end"


@query("j13_period_methods", f"with {_COUNTS}, p as (select ts_id, code, unnest([n, 60, 5]) n, unnest(['whole', 'sixty', 'five']) part from n) select ts_id, part, case {_LENGTH} when 'TINY' then 'acf' when 'SHORT' then 'acf,spectral' else case when code in ('1d', '3d', '1w', '1M', '3M') then 'acf,spectral' else 'acf,spectral,wavelet' end end methods from p")
def j13(spark, d):
    n = _both(spark, d).groupBy("ts_id").agg(F.count(F.lit(1)).alias("n"))
    parts = F.array(*[F.struct(F.lit(p).alias("part"), x.alias("n")) for p, x in (("whole", F.col("n")), ("sixty", F.lit(60).cast("long")), ("five", F.lit(5).cast("long")))])
    n = n.select("ts_id", F.inline(parts))
    return n.select("ts_id", "part", F.array_join(R.period_methods(H.frequency_class(C.interval_of()), H.length_class(F.col("n"))), ",").alias("methods"))


@query("j16_legacy_period", "with c as (select event_id, list_filter([case when event_id % 50 > 1 then event_id % 50 end, case when event_id % 3 > 0 then event_id % 7 + 1 end, case when event_id % 400 < 168 then event_id % 400 end], lambda x: x is not null) l from events), m as (select event_id, coalesce(cast(round_even(list_aggregate(l, 'median'), 0) as int), 0) p from c) select event_id, cast(case when p < 2 then 24 else p end as int) period from m")
def j16(spark, d):
    i = F.col("event_id")
    p = R.legacy_period(i % 50, F.when(i % 3 > 0, i % 7 + 1), i % 400, F.lit("1h"), F.lit(720))
    return _events(spark, d).select("event_id", p.alias("period"))


@query("h13_likely_periods", f"with {_COUNTS} select ts_id, unnest(case code when '1h' then [24, 168] when '1d' then [7, 30] end) period from n")
def h13(spark, d):
    return _both(spark, d).select("ts_id").distinct().select("ts_id", F.explode(H.likely_periods(C.interval_of())).alias("period"))


@query("h04_table_names", f"with {_COUNTS}, t as (select ts_id || unnest(['_raw', '_transformed', '_old']) table_name from n) select table_name, regexp_extract(table_name, '^(.+)_(.+)_(raw|transformed)$', 1) currency, regexp_extract(table_name, '^(.+)_(.+)_(raw|transformed)$', 2) interval_code, regexp_extract(table_name, '^(.+)_(.+)_(raw|transformed)$', 3) stage from t")
def h04(spark, d):
    names = _both(spark, d).select("ts_id").distinct().select(F.explode(F.array(*[F.concat("ts_id", F.lit(x)) for x in ("_raw", "_transformed", "_old")])).alias("table_name"))
    return names.select("table_name", H.table_parts(F.col("table_name")).alias("p")).select("table_name", "p.*")


@query("h07_thinned", f"with {BASE}, l as (select ts_id, list(round(y, 9) order by open_time) v, count(*) n from x group by 1), i as (select ts_id, v, n, unnest(range(least(n, 200))) p from l) select ts_id, cast(p as int) place, v[case when n <= 200 or p < 50 then p when p = 199 then n - 1 else cast(floor(50 + (p - 50) * ((n - 1 - 50)::double / 149)) as bigint) end + 1] y from i")
def h07(spark, d):
    lists = base(spark, d).groupBy("ts_id").agg(F.array_sort(F.collect_list(F.struct("open_time", F.round("y", 9).alias("y")))).alias("v"))
    return lists.select("ts_id", F.posexplode(H.thinned(F.transform("v", lambda x: x["y"]))).alias("place", "y"))


_FACTS = f"{BASE}, s as (select ts_id, count(*) n, avg(y) m, stddev_samp(y) sd, quantile_cont(y, 0.25) q1, median(y) q2, quantile_cont(y, 0.75) q3 from x group by 1), t as (select s.*, unnest([10, n, 5000]) k, unnest([false, true, false]) st from s)"


@query("l17_outlier_method", f"with {_FACTS} select ts_id, cast(k as bigint) n, case when k < 30 then 'lof' when st and sd / abs(m + 1e-10) < 0.5 then 'lof' when k > 500 then 'isolation_forest' when abs(q3 - q2) / abs(q2 - q1 + 1e-10) > 1.5 then 'isolation_forest' when k < 100 then 'lof' else 'isolation_forest' end method from t")
def l17(spark, d):
    s = S.basic(base(spark, d), "y")
    cases = F.array(*[F.struct(k.cast("long").alias("n"), F.lit(st).alias("st")) for k, st in ((F.lit(10), False), (F.col("length"), True), (F.lit(5000), False))])
    s = s.select("ts_id", "mean", "std", "q1", "median", "q3", F.inline(cases))
    m = R.outlier_method(F.col("n"), C.interval_of(), F.col("st"), F.col("mean"), F.col("std"), F.col("q1"), F.col("median"), F.col("q3"))
    return s.select("ts_id", "n", m.alias("method"))


@query("l12_adapted_limit", "with e as (select event_id, least(1, abs(value) / 100) q, least(0.99, greatest(-0.99, value / 80)) r from events) select event_id, round(3 * (1 + (1 - q) * 0.2) * case when abs(r) > 0.5 then least(2, sqrt((1 + r) / (1 - r))) else 1 end, 9) \"limit\" from e")
def l12(spark, d):
    v = F.col("value")
    return rounded(_events(spark, d).select("event_id", R.adapted_limit(3.0, F.abs(v) / 100, v / 80).alias("limit")), "limit")


@query("l20_cleaned", f"with {BASE}, s as (select ts_id, median(y) m from x group by 1), h as (select x.ts_id, open_time, m, case when hour(open_time) % 6 > 0 then y end y from x join s using (ts_id)) select ts_id, open_time, round(case when y is null then null when y > 50 then m else y end, 9) cleaned from h")
def l20(spark, d):
    from tidegauge.operators.outliers import cleaned

    b = base(spark, d)
    m = b.groupBy("ts_id").agg(F.median("y").alias("m"))
    b = b.withColumn("y", F.when(F.hour("open_time") % 6 > 0, F.col("y"))).join(m, "ts_id").withColumn("hit", F.coalesce(F.col("y") > 50, F.lit(False)))
    return rounded(cleaned(b, "y", "hit", "m").select("ts_id", "open_time", "cleaned"), "cleaned")


# --- regimes, microstructure, alpha ----------------------------------------------------------------------------------


@query("n19_regime_features", f"with {_SURE} select ts_id, round(tr / greatest(v, 0.001), 9) trend_volatility_ratio, round(least(100, (1 - least(0.999, greatest(0.001, nl))) / least(0.999, greatest(0.001, nl))), 9) signal_noise_ratio, round(greatest(a, 0) * tr, 9) trending_persistence, round(greatest(-a, 0) * (1 - tr), 9) reverting_tendency, round(1 - v * nl, 9) regime_stability, 0.4::double outlier_normalized, round(1 - abs(a), 9) weak_form_efficiency from s")
def n19(spark, d):
    b = base(spark, d)
    s = S.trend_and_noise(b, "y").join(b.withColumn("p", lag("y")).groupBy("ts_id").agg(F.corr("y", "p").alias("a")), "ts_id")
    got = R.regime_features(F.col("volatility"), F.col("trend_strength"), F.col("a"), F.col("noise_level"), F.lit(0.04))
    return rounded(s.select("ts_id", *[c.alias(k) for k, c in got.items()]), *got)


_KIND = "case event_id % 4 when 0 then 'volatile_trending' when 1 then 'trending' when 2 then 'stable_ranging' else 'normal' end"


@query("n19_regime_thresholds", f"with e as (select event_id, {_KIND} regime from events) select event_id, case when regime like '%volatile%' then 1.3 when regime like '%trending%' then 1.1 when regime like '%ranging%' then 0.9 else 1.0 end::double outlier_threshold_multiplier, case when regime like '%volatile%' then 1.5 when regime like '%trending%' then 0.8 when regime like '%ranging%' then 0.7 else 1.0 end::double contamination_factor, case when regime like '%volatile%' then 0.8 when regime like '%trending%' then 1.2 when regime like '%ranging%' then 1.1 else 1.0 end::double isolation_samples, case when regime like '%volatile%' then 1.2 when regime like '%trending%' then 0.9 else 1.0 end::double lof_neighbors from e")
def n19t(spark, d):
    i = F.col("event_id") % 4
    regime = F.when(i == 0, "volatile_trending").when(i == 1, "trending").when(i == 2, "stable_ranging").otherwise("normal")
    return _events(spark, d).select("event_id", R.regime_thresholds(regime).alias("t")).select("event_id", "t.*")


_MICRO = "select ts_id, noise, roll_spread, clustering from (" + registry.oracle_of("n14_variance_ratio_noise") + ") join (" + registry.oracle_of("n15_roll_spread") + ") using (ts_id) join (" + registry.oracle_of("n16_tick_clustering") + ") using (ts_id)"


@query("n16_quality", f"with m as ({_MICRO}) select ts_id, round(least(1, greatest(0, 0.2 * (1 - noise) + 0.2 * (1 - roll_spread) + 0.2 * (1 - 0.25) + 0.2 * (1 - clustering) + 0.2 * 0.3)), 8) quality from m")
def n16q(spark, d):
    b = base(spark, d)
    s = N.variance_ratio_noise(b, "y").join(N.roll_spread(b, "y"), "ts_id").join(N.tick_clustering(b, "y", 0.5), "ts_id")
    q = R.microstructure_quality(F.col("noise"), F.col("roll_spread"), F.lit(0.25), F.col("clustering"), F.lit(-0.3))
    return s.select("ts_id", F.round(q, 8).alias("quality"))


@query("n04_confidence_sharpe", "with e as (select event_id, event_id % 200 o, event_id % 5 s, event_id % 4 h, value / 100 m, event_id % 9 l, value / 500 a from events) select event_id, round(case when h > 0 then least(1, greatest(0.1, (least(1, o / 90) + least(1, s / greatest(h, 1)) + least(1, abs(m)) + least(1, l / 5)) / 4)) else 0.5 end, 9) confidence, round(least(5, greatest(-5, a / greatest(0.02, 0.01) * least(2, 1 + abs(m)))), 9) sharpe from e")
def n04c(spark, d):
    i, v = F.col("event_id"), F.col("value")
    c = R.alpha_confidence(i % 200, i % 5, i % 4, v / 100, i % 9)
    return rounded(_events(spark, d).select("event_id", c.alias("confidence"), R.alpha_sharpe(v / 500, F.lit(0.02), v / 100).alias("sharpe")), "confidence", "sharpe")


# --- tests and errors ------------------------------------------------------------------------------------------------


_PT = t_two_sided_sql("(r * sqrt((n - 2) / (1 - r * r)))", "(n - 2.0)")


@query("e14_significant_correlation", f"with {CLEAN}, es as (select ts_id, cast(count(*) as bigint) n, corr(target, reference) r from p group by 1), eq as (select *, {_PT} p from es) select ts_id, n, round(p, 7) p_value, round(case when n >= 100 and p < 0.05 then r end, 9) correlation from eq")
def e14(spark, d):
    s = R.significant_correlation(pairs(spark, d), "target", "reference")
    return rounded(s.withColumn("p_value", F.round("p_value", 7)), "correlation")


_VC = f"{EVT}, v0 as (select ts_id, open_time, open / nullif(lag(open) over ({O}), 0) - 1 a, volume / nullif(lag(volume) over ({O}), 0) - 1 b from candles_evt), v1 as (select * from v0 where a is not null and b is not null), v2 as (select ts_id, rank() over (partition by ts_id order by a) + (count(*) over (partition by ts_id, a) - 1) / 2.0 ra, rank() over (partition by ts_id order by b) + (count(*) over (partition by ts_id, b) - 1) / 2.0 rb from v1), s as (select ts_id, cast(count(*) as bigint) n, corr(ra, rb) r from v2 group by 1), q as (select *, {_PT} p from s)"


@query("e15_volume_correlation", f"with {_VC} select ts_id, n, round(p, 7) p_value, round(case when n >= 30 and p < 0.01 then r else 0 end, 9) correlation from q")
def e15v(spark, d):
    s = R.volume_correlation(T.candles_evt(spark, d), "open", "volume")
    return rounded(s.withColumn("p_value", F.round("p_value", 7)), "correlation")


_FORE = f"{BASE}, p as (select *, avg(y) over ({O} rows between 3 preceding and 1 preceding) p from x), q as (select ts_id, count(*) n, sum((y - p) ** 2) e from p where p is not null group by 1)"


@query("e17_information", f"with {_FORE} select ts_id, round(n * ln(e / n) + 6, 8) aic, round(n * ln(e / n) + 3 * ln(n), 8) bic from q")
def e17i(spark, d):
    b = base(spark, d).withColumn("p", F.avg("y").over(by_time().rowsBetween(-3, -1))).where("p IS NOT NULL")
    s = R.information(b, "y", "p")
    return s.select("ts_id", F.round("aic", 8).alias("aic"), F.round("bic", 8).alias("bic"))


_CLASS = f"{BASE}, l as (select ts_id, case when y > 40 then 'high' when y > 10 then 'mid' else 'low' end c, case when lag(y) over ({O}) > 40 then 'high' when lag(y) over ({O}) > 10 then 'mid' when lag(y) over ({O}) is not null then 'low' end p from x), k as (select * from l where p is not null), u as (select ts_id, c, count(*) n, sum((c = p)::int) h from k group by 1, 2), w as (select ts_id, p c, count(*) m from k group by 1, 2)"


@query("e18_classification", f"with {_CLASS} select ts_id, round(sum(h) / sum(n), 9) accuracy, round(sum(2.0::double * h / (n + coalesce(m, 0)) * n) / sum(n), 9) f1_weighted from u left join w using (ts_id, c) group by 1")
def e18(spark, d):
    level = lambda c: F.when(c > 40, "high").when(c > 10, "mid").when(c.isNotNull(), "low")
    b = base(spark, d).withColumn("before", lag("y"))
    b = b.select("ts_id", level(F.col("y")).alias("c"), level(F.col("before")).alias("p")).where("p IS NOT NULL")
    return rounded(R.classification(b, "c", "p"), "accuracy", "f1_weighted")


@query("o01_walk_forward", f"with {BASE}, i as (select *, row_number() over ({O}) - 1 i, count(*) over (partition by ts_id) n from x), f as (select ts_id, n, unnest(range((n - 60 - 12) // 12 + 1)) fold from (select distinct ts_id, n from i) where n >= 72) select i.ts_id, open_time, cast(fold as bigint) fold, case when i - fold * 12 < 60 then 'train' else 'test' end part from i join f on f.ts_id = i.ts_id and i >= fold * 12 and i < fold * 12 + 72")
def o01w(spark, d):
    return R.walk_forward(base(spark, d), 60, 12).select("ts_id", "open_time", F.col("fold").cast("long").alias("fold"), "part")
