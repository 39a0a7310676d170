"""Per-series kernels and streaming operators (on static tables) as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.operators import analysis as A
from tidegauge.operators import calendar as C
from tidegauge.plans.features import _END, _MID, BASE, O, base
from tidegauge.plans import registry
from tidegauge.plans.registry import query
from tidegauge.plans.relational import EVT, rounded
from tidegauge.sources import tables as T
from tidegauge.streaming import candles as X


def filled(spark, d):
    """Hourly opens without gaps."""
    c = base(spark, d)
    full = C.grid(c, "1h").join(c, ["ts_id", "open_time"], "left")
    return C.interpolate_time(full, ["y"])


FILLED = f"""{EVT}, known as (select ts_id, open_time, open y from candles_evt), fe as (select ts_id, min(open_time) lo, max(open_time) hi from known group by 1),
fg as (select ts_id, cast(unnest(generate_series(lo, hi, interval 1 hour)) as timestamp) open_time from fe), fh as (select g.ts_id, g.open_time, y from fg g left join known k on k.ts_id = g.ts_id and k.open_time = g.open_time),
fw as (select *, last_value(y ignore nulls) over b v0, last_value(case when y is not null then open_time end ignore nulls) over b t0, first_value(y ignore nulls) over a v1, first_value(case when y is not null then open_time end ignore nulls) over a t1 from fh
  window b as ({O} rows between unbounded preceding and current row), a as ({O} rows between current row and unbounded following)),
x as (select ts_id, open_time, coalesce(y, v0 + (v1 - v0) * date_diff('second', t0, open_time) / date_diff('second', t0, t1)) y from fw),
k as (select ts_id, y, row_number() over ({O}) - 1 i, count(*) over (partition by ts_id) n, y - avg(y) over (partition by ts_id) z from x)"""
_ACF = f"{FILLED}, ac as (select a.ts_id, b.i - a.i lag, any_value(a.n) n, sum(a.z * b.z) s from k a join k b on b.ts_id = a.ts_id and b.i - a.i between 0 and least(50, a.n // 3) group by 1, 2), v as (select ts_id, s s0 from ac where lag = 0)"


@query("i06_acf", f"with {_ACF} select ts_id, cast(lag as int) lag, round(s / (n - lag) / (s0 / n), 9) acf from ac join v using (ts_id)")
def i06(spark, d):
    return rounded(A.analyse(filled(spark, d), "y", "acf").select("ts_id", F.posexplode("acf").alias("lag", "acf")), "acf")


def chi2_sf_sql(x: str, df: str) -> str:
    """The upper tail of chi-squared: the density over the root, integrated by Simpson's rule in 2,000 steps."""
    h = f"(sqrt({x} / 2) / 2000)"
    whole = f"list_sum(list_transform(range(2001), lambda j: (case when j = 0 or j = 2000 then 1 when j % 2 = 1 then 4 else 2 end) * pow(j * {h}, {df} - 1) * exp(-pow(j * {h}, 2))))"
    return f"greatest(0, 1 - 2 / exp(lgamma({df} / 2.0)) * {h} / 3 * {whole})"


_LB = f"{_ACF}, lb as (select ts_id, lag, n * (n + 2) * sum(pow(s / s0, 2) / (n - lag)) over (partition by ts_id order by lag) q from ac join v using (ts_id) where lag between 1 and 10)"


@query("k15_whiteness", f"with {_LB} select ts_id, round(min({chi2_sf_sql('q', 'lag')}), 7) ljung_box_p, 'success' status, '' message from lb group by 1")
def k15(spark, d):
    return A.analyse(filled(spark, d), "y", "whiteness").withColumn("ljung_box_p", F.round("ljung_box_p", 7))


_SMOOTH = f"""{FILLED}, al as (select (unnest(range(1, 20)) / 20.0)::double a), fc as (select t.ts_id, a, t.i, any_value(t.y) y, any_value(t.n) n, sum(s.y * case when s.i = 0 then pow(1 - a, t.i - 1) else a * pow(1 - a, t.i - 1 - s.i) end) f
  from k t join k s on s.ts_id = t.ts_id and s.i < t.i, al where t.i > 0 group by 1, 2, 3),
sm as (select ts_id, a, 100 * sum(case when abs(y) + abs(f) > 0 then 2 * abs(y - f) / (abs(y) + abs(f)) else 0 end) / (any_value(n) - 1) e from fc group by 1, 2)"""


@query("o02_smoothing_search", f"with {_SMOOTH} select ts_id, round(arg_min(a, e), 9) alpha, round(min(e), 7) smape, 'success' status, '' message from sm group by 1")
def o02(spark, d):
    got = A.analyse(filled(spark, d), "y", "smoothing_search")
    return got.withColumns({"alpha": F.round("alpha", 9), "smape": F.round("smape", 7)})


def _kernel(key: str, name: str):
    query(key)(lambda spark, d: A.analyse(filled(spark, d), "y", name))


for _key, _name in (("i01_stationarity", "stationarity"), ("i07_canonical", "canonical"), ("j03_wavelet_periods", "wavelet_periods"), ("j08_period_consensus", "periodicity"), ("k17_boxcox", "boxcox")):
    _kernel(_key, _name)


def _method(key: str, method: str | None):
    query(key)(lambda spark, d: A.decompose(filled(spark, d), "y", method, None if method is None else 24))


for _key, _name in (("k02_ssa", "ssa"), ("k03_mstl", "mstl"), ("k04_stl", "stl"), ("k04_robust_stl", "robust_stl"), ("k07_additive_regression", "additive_regression"), ("k13_decompose", None)):
    _method(_key, _name)


@query("l14_isolation_forest")
def l14(spark, d):
    return A.replace_outliers(base(spark, d), "y", "isolation_forest")


_DFT = f"""{FILLED}, ln as (select *, regr_slope(y, i) over (partition by ts_id) b1, regr_intercept(y, i) over (partition by ts_id) b0 from k), de as (select ts_id, i, n, y, b0 + b1 * i line, y - b0 - b1 * i d, z from ln),
fr as (select ts_id, n, unnest(range(1, n // 2 + 1)) f from (select distinct ts_id, n from k))"""


def _power_sql(value: str) -> str:
    return f"select fr.ts_id, f, any_value(fr.n) n, sum({value} * cos(2 * pi() * f * i / fr.n)) re, sum({value} * sin(2 * pi() * f * i / fr.n)) im from fr join de on de.ts_id = fr.ts_id group by 1, 2"


_LEGACY = f"""{_DFT}, pw as ({_power_sql('z')}), bf as (select ts_id, arg_max(f, (re * re + im * im, -f)) f from pw group by 1),
la as (select a.ts_id, b.i - a.i lag, sum(a.z * b.z) s from k a join k b on b.ts_id = a.ts_id and b.i - a.i between 0 and least(365, a.n - 1) group by 1, 2),
lf as (select la.ts_id, min(lag) lag from la join (select ts_id, s s0 from la where lag = 0) using (ts_id) where lag > 0 and s / s0 > 0.3 group by 1)"""


@query("j15_legacy_period", f"with {_LEGACY} select n.ts_id, cast(greatest(2, least(coalesce(lag, n), cast(round_even(n / f, 0) as bigint))) as int) period, 'success' status, '' message from (select distinct ts_id, n from k) n join bf using (ts_id) left join lf using (ts_id)")
def j15(spark, d):
    return A.analyse(filled(spark, d), "y", "legacy_period")


_FOURIER = f"""{_DFT}, pw as (select *, re * re + im * im p from ({_power_sql('d')})), pk as (select *, coalesce(lag(p) over (partition by ts_id order by f), 0) p0, coalesce(lead(p) over (partition by ts_id order by f), 0) p1, max(p) over (partition by ts_id) top from pw),
hs as (select * from pk where p > p0 and p > p1 and p >= 0.05 * top qualify row_number() over (partition by ts_id order by p desc, f) <= greatest(1, least(10, 12, n // 4))),
ss as (select de.ts_id, de.i, sum(case when 2 * f = de.n then 1 else 2 end / de.n::double * (re * cos(2 * pi() * f * de.i / de.n) + im * sin(2 * pi() * f * de.i / de.n))) s from de join hs on hs.ts_id = de.ts_id group by 1, 2),
tm as (select ts_id, open_time, row_number() over ({O}) - 1 i from x)"""


@query("k01_fourier", f"with {_FOURIER} select tm.ts_id, open_time, round(line, 7) trend, round(s, 7) seasonal, round(d - s, 7) residual, 'fourier' \"method\", 24 period, 'success' status, '' message from tm join de using (ts_id, i) join ss using (ts_id, i)")
def k01(spark, d):
    got = A.decompose(filled(spark, d), "y", "fourier", 24)
    return got.withColumns({c: F.round(c, 7) for c in ("trend", "seasonal", "residual")})


def _peaks_sql(src: str, name: str) -> str:
    """CTEs that end in ``name(ts_id, k, v, prom)``: the local maxima of ``src(ts_id, k, v)`` with their prominences."""
    return f"""{name}0 as (select * from (select *, lag(v) over (partition by ts_id order by k) v0, lead(v) over (partition by ts_id order by k) v1 from {src}) where v > v0 and v > v1),
{name}1 as (select p.ts_id, p.k, p.v, coalesce(max(s.k) filter (s.k < p.k and s.v > p.v), min(s.k)) a, coalesce(min(s.k) filter (s.k > p.k and s.v > p.v), max(s.k)) b from {name}0 p join {src} s on s.ts_id = p.ts_id group by 1, 2, 3),
{name} as (select p.ts_id, p.k, p.v, p.v - greatest(min(s.v) filter (s.k between a and p.k), min(s.v) filter (s.k between p.k and b)) prom from {name}1 p join {src} s on s.ts_id = p.ts_id group by 1, 2, 3)"""


def _trust_sql(period: str, confidence: str) -> str:
    return f"least(1, {confidence} * case when {period} < 3 then 0.7 else 1 end * case when {period} / n > 0.5 then 1.5 - {period} / n else 1 end * case when n / {period} < 2 then 0.8 else 1 end)"




def _most_sql(n: str) -> str:
    return f"(case when {n} < 100 then {n} // 3 when {n} < 1000 then least({n} // 3, 300) else least({n} // 4, 500) end)"


_ACF_PEAKS = f"""{_DFT}, av as (select a.ts_id, b.i - a.i k, any_value(a.n) n, sum(a.d * b.d) / (any_value(a.n) - (b.i - a.i)) c from de a join de b on b.ts_id = a.ts_id and b.i - a.i between 0 and least(greatest(least(a.n // 2, {_most_sql('a.n')}, 1000), 10), a.n - 2) group by 1, 2),
src as (select av.ts_id, k, n, c / c0 v from av join (select ts_id, c c0 from av where k = 0) using (ts_id)), {_peaks_sql('src', 'pk')},
rt as (select pk.ts_id, k period, {_trust_sql('k', 'v * least(1, prom / 0.2)')} confidence from pk join (select distinct ts_id, n from k) using (ts_id) where v >= least(0.5, greatest(0.05, 1.96 / sqrt(n))) and prom >= 0.1 and k >= 2)"""
_FOUND = "select ts_id, cast(period as int) period, round(confidence, 7) confidence from rt qualify row_number() over (partition by ts_id order by confidence desc, period) <= 10"


def _periods(spark, d, name: str):
    found = A.analyse(filled(spark, d), "y", name)
    return found.select("ts_id", F.inline(F.arrays_zip("periods", "confidences"))).select("ts_id", F.col("periods").alias("period"), F.round("confidences", 7).alias("confidence"))


@query("j01_acf_periods", f"with {_ACF_PEAKS} {_FOUND}")
def j01(spark, d):
    return _periods(spark, d, "acf_periods")


_WELCH = f"""{_DFT}, sz as (select distinct ts_id, n, least(512, cast(pow(2, greatest(3, floor(log2(greatest(8, n / 4))))) as bigint)) size from k),
sg as (select ts_id, n, size, unnest(range(0, n - size + 1, size // 2)) b from sz), sm as (select sg.ts_id, b, size, i - b j, d - avg(d) over (partition by sg.ts_id, b) d from sg join de on de.ts_id = sg.ts_id and i between b and b + size - 1),
sw as (select ts_id, b, size, j, d * (0.5 - 0.5 * cos(2 * pi() * j / size)) d from sm), sf as (select distinct ts_id, size, unnest(range(2 * size + 1)) k from sz),
sp as (select sw.ts_id, b, k, any_value(sw.size) size, pow(sum(d * cos(2 * pi() * k * j / (4 * sw.size))), 2) + pow(sum(d * sin(2 * pi() * k * j / (4 * sw.size))), 2) p from sw join sf on sf.ts_id = sw.ts_id group by 1, 2, 3),
src as (select ts_id, k, any_value(size) size, avg(p) v from sp group by 1, 2), {_peaks_sql('src', 'pk')},
mx as (select ts_id, max(v) top from src group by 1), ch as (select pk.*, top from pk join mx using (ts_id) where v >= 0.2 * top and prom >= 0.06 * top qualify row_number() over (partition by ts_id order by v desc) <= 5),
vx as (select ch.ts_id, ch.v / top share, any_value(m.size) size, ch.k, max(ln(m.v)) filter (m.k = ch.k - 1) a, max(ln(m.v)) filter (m.k = ch.k) b, max(ln(m.v)) filter (m.k = ch.k + 1) c from ch join src m on m.ts_id = ch.ts_id and m.k between ch.k - 1 and ch.k + 1 group by ch.ts_id, ch.v, top, ch.k),
rw as (select *, 4 * size / (k + 0.5 * (a - c) / (a - 2 * b + c)) w from vx), pr as (select rw.*, cast(round_even(w, 0) as bigint) p, n from rw join (select ts_id ti, n from sz) on ti = rw.ts_id),
rt as (select ts_id, p period, max({_trust_sql('p', 'share * (1 - least(3 * abs(w - p) / p, 0.7))')}) confidence from pr where p >= 2 and p <= {_most_sql('n')} group by 1, 2)"""


@query("j02_spectral_periods", f"with {_WELCH} {_FOUND}")
def j02(spark, d):
    return _periods(spark, d, "spectral_periods")


_SHAPE = f"""{FILLED}, st as (select ts_id, y, row_number() over (partition by ts_id order by y) r, n from k),
mr as (select *, case when r = n then pow(0.5, 1.0 / n) when r = 1 then 1 - pow(0.5, 1.0 / n) else (r - 0.3175) / (n + 0.365) end p from st), me as (select *, sqrt(-2 * ln(case when p < 0.5 then p else 1 - p end)) e from mr),
qq as (select ts_id, corr(y, case when p < 0.02425 then {_END} when p > 1 - 0.02425 then -{_END} else {_MID} end) q from me group by 1),
wd as (select ts_id, count(*) n, min(y) lo, max(y) hi, 2 * (quantile_cont(y, 0.75) - quantile_cont(y, 0.25)) / cbrt(count(*)) fd, (max(y) - min(y)) / (log2(count(*)) + 1) sturges from k group by 1),
bn as (select *, cast(ceil((hi - lo) / (case when fd > 0 then least(fd, sturges) else sturges end)) as bigint) bins from wd),
hc as (select k.ts_id, least(bins - 1, cast(floor((y - lo) / ((hi - lo) / bins)) as bigint)) k, count(*) c from k join bn using (ts_id) group by 1, 2),
al as (select ts_id, unnest(range(-1, bins + 1)) k from bn), h0 as (select al.ts_id, al.k, coalesce(c, 0) v from al left join hc on hc.ts_id = al.ts_id and hc.k = al.k),
src as (select ts_id, cast(row_number() over (partition by ts_id order by k) as bigint) k, v from (select *, v is distinct from lag(v) over (partition by ts_id order by k) is_new from h0) where is_new), {_peaks_sql('src', 'pk')},
nm as (select ts_id, count(*) filter (prom >= 0.1 * top) m from pk join (select ts_id, max(v) top from src group by 1) using (ts_id) group by 1)"""


@query("e09_shape", f"with {_SHAPE} select ts_id, round(q, 7) qq_correlation, m > 1 is_multimodal, 'success' status, '' message from qq join nm using (ts_id)")
def e09(spark, d):
    return A.analyse(filled(spark, d), "y", "shape").withColumn("qq_correlation", F.round("qq_correlation", 7))


_SMOOTHED = f"""{FILLED}, tm as (select ts_id, open_time, y, row_number() over ({O}) - 1 i, count(*) over (partition by ts_id) n from x), w as (select *, greatest(3, least(24, n // 2)) w from tm),
o as (select *, unnest(range(w)) - w // 2 o from w), tr as (select o.ts_id, o.i, avg(k.y) t from o join tm k on k.ts_id = o.ts_id and k.i = least(o.n - 1, greatest(0, o.i + o.o)) group by 1, 2),
dd as (select tm.*, t, avg(y - t) over (partition by ts_id, i % 24) s0 from tm join tr using (ts_id, i)), sc as (select *, s0 - avg(s0) over (partition by ts_id) s from dd)"""


@query("k06_smoothed", f"with {_SMOOTHED} select ts_id, open_time, round(t, 9) trend, round(s, 9) seasonal, round(y - t - s, 9) residual, 'smoothed' \"method\", 24 period, 'success' status, '' message from sc")
def k06(spark, d):
    got = A.decompose(filled(spark, d), "y", "smoothed", 24)
    return got.withColumns({c: F.round(c, 9) for c in ("trend", "seasonal", "residual")})


@query("k20_redecompose", registry.oracle_of("k06_smoothed"))
def k20(spark, d):
    f = filled(spark, d)
    stored = f.select("ts_id").distinct().select("ts_id", F.lit("smoothed").alias("method"), F.lit(24).alias("period"))
    got = A.redecompose(f, "y", stored)
    return got.withColumns({c: F.round(c, 9) for c in ("trend", "seasonal", "residual")})


_LOF = f"""b as (select ts_id, open_time, y, row_number() over ({O}) i, row_number() over (partition by ts_id order by y, open_time) r, count(*) over (partition by ts_id) n from x), kk as (select *, least(least(20, greatest(5, n // 20)), n - 1) k from b),
nb as (select a.ts_id, a.r, a.k, c.r q, abs(c.y - a.y) d from kk a join kk c on c.ts_id = a.ts_id and c.r <> a.r and c.r between a.r - a.k and a.r + a.k qualify row_number() over (partition by a.ts_id, a.r order by abs(c.y - a.y), c.r) <= a.k),
far as (select ts_id, r, max(d) far from nb group by 1, 2), den as (select nb.ts_id, nb.r, 1 / greatest(avg(greatest(d, far.far)), 1e-10) density from nb join far on far.ts_id = nb.ts_id and far.r = nb.q group by 1, 2),
sc as (select nb.ts_id, nb.r, avg(o.density) / any_value(m.density) score from nb join den o on o.ts_id = nb.ts_id and o.r = nb.q join den m on m.ts_id = nb.ts_id and m.r = nb.r group by 1, 2),
q as (select ts_id, quantile_cont(y, 0.25) q1, quantile_cont(y, 0.75) q3 from x group by 1), sh as (select ts_id, round_even(least(0.3, avg((y < q1 - 1.5 * (q3 - q1) or y > q3 + 1.5 * (q3 - q1))::int)) * count(*), 0) m from x join q using (ts_id) group by 1),
fl as (select b.ts_id, open_time, y, score, row_number() over (partition by b.ts_id order by score desc, i) <= m is_outlier from b join sc using (ts_id, r) join sh using (ts_id)), md as (select ts_id, median(y) med from fl where not is_outlier group by 1)"""


@query("l15_lof", f"with {BASE}, {_LOF} select ts_id, open_time, is_outlier, round(score, 7) score, round(case when is_outlier then med else y end, 9) cleaned from fl join md using (ts_id)")
def l15(spark, d):
    got = A.replace_outliers(base(spark, d), "y", "lof")
    return got.withColumns({"score": F.round("score", 7), "cleaned": F.round("cleaned", 9)})


@query("l18_clean_residual", f"with {BASE.replace(' x as (', ' x0 as (')}, parts as (with {_SMOOTHED} select ts_id, open_time, t trend, s seasonal, y - t - s residual from sc), x as (select ts_id, open_time, residual y from parts), {_LOF} select ts_id, open_time, is_outlier, round(trend + seasonal + case when is_outlier then med else residual end, 9) cleaned from fl join md using (ts_id) join parts using (ts_id, open_time)")
def l18(spark, d):
    got = A.clean_residual(filled(spark, d), "y", "smoothed", "lof", 24)
    return got.withColumn("cleaned", F.round("cleaned", 9))


@query("q02_tumbling_candles", f"with {EVT} select ts_id, open_time, round(open, 9) open, round(high, 9) high, round(low, 9) low, round(\"close\", 9) \"close\", round(volume, 9) volume, number_of_trades from candles_evt")
def q02(spark, d):
    c = X.tumbling_candles(X.ticks(T.table(spark, d, "events"), None))
    return rounded(c, "open", "high", "low", "close", "volume")


@query("q03_sliding_volume", "with s as (select 'crypto_'||event_type||'_1h' ts_id, date_trunc('hour', ts) - to_hours(cast(k as int)) \"start\", abs(value) v from events, range(24) r(k)) select ts_id, cast(\"start\" as timestamp) \"start\", round(sum(v), 9) volume from s group by 1, 2")
def q03(spark, d):
    return rounded(X.sliding_volume(X.ticks(T.table(spark, d, "events"), None)), "volume")


@query("q03_sessions", "with e as (select 'crypto_'||event_type||'_1h' ts_id, ts, coalesce(ts >= lag(ts) over (partition by event_type order by ts) + interval 2 hour, true)::int new from events), s as (select *, sum(new) over (partition by ts_id order by ts rows unbounded preceding) g from e) select ts_id, min(ts) \"start\", cast(max(ts) + interval 2 hour as timestamp) stop, cast(count(*) as bigint) n from s group by ts_id, g")
def q03s(spark, d):
    return X.sessions(X.ticks(T.table(spark, d, "events"), None))


@query("q06_deduplicated", "select 'crypto_'||event_type||'_1h' ts_id, event_id from events")
def q06(spark, d):
    t = X.ticks(T.table(spark, d, "events"), None)
    return X.deduplicated(t.union(t)).select("ts_id", "event_id")
