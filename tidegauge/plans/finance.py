"""Cross-series and event statistics as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.operators import finance as N
from tidegauge.operators import stats as S
from tidegauge.plans.features import BASE, O, base, over
from tidegauge.plans import registry
from tidegauge.plans.registry import query
from tidegauge.plans.relational import rounded

REF = "crypto_view_1h"
RAW = f"{BASE}, q as (select ts_id, open_time, y / nullif(lag(y) over ({O}), 0) - 1 r from x), s as (select ts_id, median(r) med, mad(r) mad from q group by 1)"
CLEAN = f"{RAW}, c as (select q.ts_id, open_time, r from q join s using (ts_id) where r is not null and (mad = 0 or 0.6745 * abs(r - med) / mad < 3)), p as (select c.ts_id, c.open_time, c.r target, f.r reference from c join c f on f.open_time = c.open_time and f.ts_id = '{REF}' where c.ts_id <> '{REF}')"


def pairs(spark, d):
    return N.aligned_returns(base(spark, d), REF, "y")


@query("n09_clean_returns", f"with {CLEAN} select ts_id, open_time, round(target, 9) target, round(reference, 9) reference from p")
def n09(spark, d):
    return rounded(pairs(spark, d), "target", "reference")


@query("e13_market_beta", f"with {CLEAN} select ts_id, cast(count(*) as bigint) n, round(covar_samp(target, reference), 9) covariance, round(case when count(*) >= 100 then covar_samp(target, reference) / var_samp(reference) end, 9) beta, round(case when count(*) >= 100 then corr(target, reference) end, 9) correlation from p group by 1")
def e13(spark, d):
    return rounded(N.market_beta(pairs(spark, d)), "covariance", "beta", "correlation")


_LL = ", ".join(f"abs(corr(target, r{k + 20})) c{k + 20}" for k in range(-20, 21))
_LAGGED = ", ".join(f"{'lag' if k >= 0 else 'lead'}(reference, {abs(k)}) over ({O}) r{k + 20}" for k in range(-20, 21))
_ALL = " union all ".join(f"select ts_id, {k} k, c{k + 20} a from m" for k in range(-20, 21))


@query("n10_lead_lag", f"with {CLEAN}, l as (select *, {_LAGGED} from p), m as (select ts_id, {_LL} from l group by 1), u as ({_ALL}) select ts_id, round(arg_max(k, (a, -abs(k), k)) / 20.0, 9) lead_lag, round(max(a), 9) strength from u group by 1")
def n10(spark, d):
    return rounded(N.lead_lag(pairs(spark, d)), "lead_lag", "strength")


_RC = f"{CLEAN}, rc as (select *, case when var_samp(target) over {over(50)} > 1e-8 and var_samp(reference) over {over(50)} > 1e-8 and count(*) over {over(50)} = 50 then corr(target, reference) over {over(50)} end c, stddev_samp(reference) over {over(50)} vol from p)"


@query("n11_contagion", f"with {_RC}, k as (select * from rc where c is not null), t as (select ts_id, quantile_cont(vol, 0.75) cut from k group by 1), a as (select ts_id, avg(case when vol > cut then c end) crisis, avg(case when vol <= cut then c end) tranquil, avg(case when vol > cut then vol * vol end) vc, avg(case when vol <= cut then vol * vol end) vt from k join t using (ts_id) group by 1), z as (select *, crisis / sqrt(1 + (vc / vt - 1) * (1 - crisis * crisis)) adjusted from a) select ts_id, round(crisis, 9) crisis, round(tranquil, 9) tranquil, round(adjusted, 9) adjusted, round(adjusted - tranquil, 9) contagion from z")
def n11(spark, d):
    return rounded(N.contagion(pairs(spark, d)), "crisis", "tranquil", "adjusted", "contagion")


@query("n12_isolation", f"with {_RC} select ts_id, round(avg((abs(c) < 0.3)::int), 9) isolation_ratio, round(1 / (1 + stddev_samp(c) / abs(avg(c))), 9) stability from rc where c is not null group by 1")
def n12(spark, d):
    return rounded(N.isolation(pairs(spark, d)), "isolation_ratio", "stability")


_R = f"{BASE}, q as (select ts_id, open_time, y / nullif(lag(y) over ({O}), 0) - 1 r from x), w as (select * from q where r is not null)"


@query("n14_variance_ratio_noise", f"with {_R}, v as (select *, " + ", ".join(f"case when count(r) over {over(k)} = {k} then sum(r) over {over(k)} end s{k}" for k in (2, 5, 10)) + " from w) select ts_id, round(greatest(0, 1 - (" + " + ".join(f"var_samp(s{k}) / ({k} * var_samp(r))" for k in (2, 5, 10)) + ") / 3), 9) noise from v group by 1")
def n14(spark, d):
    return rounded(N.variance_ratio_noise(base(spark, d), "y"), "noise")


@query("n15_roll_spread", f"with {_R}, l as (select *, lag(r) over ({O}) p from w) select ts_id, round(least(1, greatest(0, -2 * corr(r, p)) / 0.1), 9) roll_spread from l group by 1")
def n15(spark, d):
    return rounded(N.roll_spread(base(spark, d), "y"), "roll_spread")


_FP = f"{BASE}, f as (select *, " + ", ".join(f"lead(y, {h}) over ({O}) / nullif(y, 0) - 1 f{h}" for h in (1, 5, 10, 20)) + " from x), g as (select * from f where hour(open_time) % 6 = 0 and f20 is not null), u as (" + " union all ".join(f"select ts_id, open_time, {h} horizon, f{h} ret from g" for h in (1, 5, 10, 20)) + ")"


@query("n01_forward_panel", f"with {_FP} select ts_id, open_time, cast(horizon as int) horizon, round(ret, 9) ret from u")
def n01(spark, d):
    return rounded(N.forward_panel(base(spark, d), F.hour("open_time") % 6 == 0, "y"), "ret")


@query("n02_predictive_power", f"with {_FP} select ts_id, cast(horizon as int) horizon, cast(count(*) as bigint) n, round(avg(ret), 9) mean, round(stddev_samp(ret), 9) std, round(avg((ret > 0)::int), 9) hit_rate, round(avg(ret) / stddev_samp(ret), 9) information_ratio, round(avg(ret) / stddev_samp(ret) * sqrt(count(*)), 9) t_statistic from u group by 1, 2 having count(*) >= 30")
def n02(spark, d):
    panel = N.forward_panel(base(spark, d), F.hour("open_time") % 6 == 0, "y")
    return rounded(N.predictive_power(panel), "mean", "std", "hit_rate", "information_ratio", "t_statistic")


@query("n03_alpha_score", f"with {_R} select ts_id, round(tanh(avg(r) / stddev_samp(r)), 9) score from w group by 1")
def n03(spark, d):
    s = S.return_stats(base(spark, d), "y")
    return rounded(s.select("ts_id", N.alpha_score(F.col("returns_mean"), F.col("returns_volatility")).alias("score")), "score")


@query("n04_alpha_potential", "select event_id, round(least(1, greatest(-1, 0.5 * case event_type when 'view' then 1.0 when 'click' then -1.0 else 0.5 end * tanh(2 * abs(value / 100)) / (1 + exp(-(value / 50 - 3))))), 9) potential from events")
def n04(spark, d):
    from tidegauge.sources.tables import table

    e = table(spark, d, "events")
    kind = F.when(F.col("event_type") == "view", "momentum").when(F.col("event_type") == "click", "mean_reversion").otherwise("other")
    return rounded(e.select("event_id", N.alpha_potential(F.lit(0.5), kind, F.col("value") / 100, F.col("value") / 50).alias("potential")), "potential")


_NEAR = f"{BASE}, k as (select *, row_number() over ({O}) i from x), w as (select e.ts_id, e.open_time event_time, k.i - e.i o, k.y v from k e join k on k.ts_id = e.ts_id and k.i between e.i - 20 and e.i + 20 where hour(e.open_time) = 12)"


@query("n05_mean_reversion", f"with {_NEAR}, s as (select ts_id, event_time, avg(v) filter (o < 0) b, max(v) filter (o = 0) a, avg(v) filter (o > 0) f from w group by 1, 2) select ts_id, event_time, round(least(1, greatest(0, 1 - abs(f - b) / nullif(abs(a - b), 0))), 9) strength from s")
def n05(spark, d):
    return rounded(N.mean_reversion(base(spark, d), F.hour("open_time") == 12, "y"), "strength")


@query("n06_momentum", f"with {_NEAR}, s as (select ts_id, event_time, arg_min(v, o) b, max(v) filter (o = 0) a, arg_max(v, o) f from w group by 1, 2) select ts_id, round(avg((sign(a - b) = sign(f - a))::int), 9) persistence, cast(count(*) as bigint) n_events from s group by 1")
def n06(spark, d):
    return rounded(N.momentum(base(spark, d), F.hour("open_time") == 12, "y"), "persistence")


_EV = f"{RAW}, z as (select q.ts_id, open_time, case when mad > 0 then 0.6745 * abs(r - med) / mad else 0 end score from q join s using (ts_id) where r is not null), nr as (select *, max(score) over ({O} rows between 3 preceding and 3 following) near from z)"


@query("n13_event_validation", f"with {_EV} select a.ts_id, a.open_time, round(a.near, 9) near, round(b.near, 9) near_reference, a.near > 2 and b.near > 1.5 is_valid from nr a join nr b on b.open_time = a.open_time and b.ts_id = '{REF}' where hour(a.open_time) = 12 and a.ts_id <> '{REF}'")
def n13(spark, d):
    return rounded(N.event_validation(base(spark, d), F.hour("open_time") == 12, "y", REF), "near", "near_reference")


@query("n17_regime", f"with {BASE}, t as (select *, row_number() over ({O}) - 1 i, lag(y) over ({O}) p from x), s as (select ts_id, stddev_samp(y) / abs(avg(y)) v, least(1, greatest(0, least(1, 100 * abs(regr_slope(y, i)) / (abs(avg(y)) + 1e-10)) * regr_r2(y, i))) tr, corr(y, p) a from t group by 1), w as (select *, 0.7 * a + 0.3 * tr pe from s) select ts_id, case when v > 0.5 and tr > 0.4 then 'volatile_trending' when v > 0.5 then 'volatile' when tr > 0.4 and pe > 0.55 then 'trending' when pe < 0.45 then case when v < 0.15 then 'quiet' else 'mean_reverting' end else 'normal' end regime from w")
def n17(spark, d):
    from tidegauge.operators.windows import lag

    b = base(spark, d)
    acf = b.withColumn("p", lag("y")).groupBy("ts_id").agg(F.corr("y", "p").alias("a"))
    s = S.trend_and_noise(b, "y").join(acf, "ts_id")
    return s.select("ts_id", N.regime(F.col("volatility"), F.col("trend_strength"), F.col("a")).alias("regime"))


@query("n08_cross_asset", "select * from (" + ") left join (".join(f"{registry.oracle_of(k)}{') using (ts_id' if j else ''}" for j, k in enumerate(("e13_market_beta", "n10_lead_lag", "n11_contagion", "n12_isolation"))) + ")")
def n08(spark, d):
    got = N.cross_asset(base(spark, d), REF, "y")
    return rounded(got, *[c for c, t in got.dtypes if t == "double"])


@query("n07_validation_summary", f"with {_FP} select ts_id, cast(count(*) as bigint) n, round(avg((ret > 0)::int), 9) success_rate, round(avg(ret), 9) mean, round(min(ret), 9) worst, round(max(ret), 9) best from u group by 1")
def n07(spark, d):
    panel = N.forward_panel(base(spark, d), F.hour("open_time") % 6 == 0, "y")
    return rounded(N.validation_summary(panel), "success_rate", "mean", "worst", "best")


@query("n16_session_effect", f"with {_R}, z as (select *, hour(open_time) >= 9 and hour(open_time) < 16 o from w) select ts_id, round(stddev_samp(case when o then r end), 9) inside, round(stddev_samp(case when not o then r end), 9) outside, round(stddev_samp(case when o then r end) / stddev_samp(case when not o then r end), 9) session_effect from z group by 1")
def n16(spark, d):
    h = F.hour("open_time")
    return rounded(N.session_effect(base(spark, d), "y", (h >= 9) & (h < 16)), "inside", "outside", "session_effect")


@query("n16_tick_clustering", f"with {BASE} select ts_id, round(greatest(0, (avg((abs(round(y / 0.5)) % 10 = 0)::int) - 0.1) / 0.9), 9) clustering from x group by 1")
def n16t(spark, d):
    return rounded(N.tick_clustering(base(spark, d), "y", 0.5), "clustering")


@query("f13_volatility_regimes", f"with {_R}, v as (select *, case when count(r) over {over(50)} = 50 then stddev_samp(r) over {over(50)} end vol from w), t as (select ts_id, quantile_cont(vol, 0.75) cut from v group by 1) select ts_id, open_time, round(vol, 9) vol, vol > cut is_high from v join t using (ts_id) where vol is not null")
def f13(spark, d):
    return rounded(N.volatility_regimes(base(spark, d), "y"), "vol")


def t_two_sided_sql(t: str, df: str) -> str:
    """Two-sided p-value of Student's t: the density over the angle of t, integrated by Simpson's rule in 2,000 steps."""
    h = f"(atan(abs({t}) / sqrt({df})) / 2000)"
    whole = f"list_sum(list_transform(range(2001), lambda i: (case when i = 0 or i = 2000 then 1 when i % 2 = 1 then 4 else 2 end) * pow(cos(i * {h}), {df} - 1)))"
    return f"greatest(0, 1 - 2 * exp(lgamma(({df} + 1) / 2) - lgamma({df} / 2)) / sqrt(pi()) * {h} / 3 * {whole})"


_POWER = f"{_FP}, pw as (select ts_id, cast(horizon as int) horizon, cast(count(*) as bigint) n, avg(ret) mean, stddev_samp(ret) std, avg((ret > 0)::int) hit_rate, avg(ret) / stddev_samp(ret) information_ratio, avg(ret) / stddev_samp(ret) * sqrt(count(*)) t_statistic from u group by 1, 2 having count(*) >= 30)"
_PV = f"{_POWER}, pv as (select *, {t_two_sided_sql('t_statistic', '(n - 1.0)')} p_value from pw), pq as (select *, p_value * count(p_value) over (partition by ts_id) / row_number() over (partition by ts_id order by p_value, horizon) q from pv)"


@query("n02_p_values", f"with {_PV} select ts_id, horizon, n, round(mean, 9) mean, round(t_statistic, 9) t_statistic, round(p_value, 7) p_value, round(least(1, min(q) over (partition by ts_id order by p_value desc, horizon desc rows unbounded preceding)), 7) p_adjusted from pq")
def n02p(spark, d):
    panel = N.forward_panel(base(spark, d), F.hour("open_time") % 6 == 0, "y")
    got = N.with_p_values(N.predictive_power(panel)).select("ts_id", "horizon", "n", "mean", "t_statistic", F.round("p_value", 7).alias("p_value"), F.round("p_adjusted", 7).alias("p_adjusted"))
    return rounded(got, "mean", "t_statistic")


def _erf_sql(x: str) -> str:
    t = f"(1 / (1 + 0.3275911 * ({x})))"
    return f"(1 - ((((1.061405429 * {t} - 1.453152027) * {t} + 1.421413741) * {t} - 0.284496736) * {t} + 0.254829592) * {t} * exp(-({x}) * ({x})))"


_SURE = f"{BASE}, t as (select *, row_number() over ({O}) - 1 i, lag(y) over ({O}) p, y - 2 * lag(y) over ({O}) + lag(y, 2) over ({O}) dd from x), s as (select ts_id, count(*)::double n, stddev_samp(y) / abs(avg(y)) v, least(1, greatest(0, least(1, 100 * abs(regr_slope(y, i)) / (abs(avg(y)) + 1e-10)) * regr_r2(y, i))) tr, corr(y, p) a, least(1, greatest(0, stddev_samp(dd) / stddev_samp(y))) nl from t group by 1)"


@query("n18_regime_confidence", f"with {_SURE} select ts_id, round(least(1, greatest(0, 0.35 * least(1, greatest(0, {_erf_sql('least(abs(v - 0.15), abs(v - 0.5)) / greatest(v / sqrt(2 * n), 1e-6) / sqrt(2)')})) + 0.35 * least(1, greatest(0, {_erf_sql('sqrt(tr * n / 2)')})) + 0.2 * least(1, greatest(0, {_erf_sql('abs(a) * sqrt(n / 2)')})) + 0.1 * (1 - nl))), 9) confidence from s")
def n18(spark, d):
    from tidegauge.operators.windows import lag

    b = base(spark, d)
    acf = b.withColumn("p", lag("y")).groupBy("ts_id").agg(F.corr("y", "p").alias("a"), F.count(F.lit(1)).alias("n"))
    s = S.trend_and_noise(b, "y").join(acf, "ts_id")
    got = N.regime_confidence(F.col("volatility"), F.col("trend_strength"), F.col("a"), F.col("noise_level"), F.col("n"))
    return rounded(s.select("ts_id", got.alias("confidence")), "confidence")
