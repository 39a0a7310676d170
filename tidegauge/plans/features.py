"""Windowed features and scalers as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegauge.operators import windows as W
from tidegauge.plans.registry import query
from tidegauge.plans.relational import EVT, rounded
from tidegauge.sources import tables as T

BASE = f"{EVT}, x as (select ts_id, open_time, open y from candles_evt)"
O = "partition by ts_id order by open_time"  # noqa: E741


def over(n: int) -> str:
    return f"({O} rows between {n - 1} preceding and current row)"


def base(spark, d):
    return T.candles_evt(spark, d).select("ts_id", "open_time", F.col("open").alias("y"))


def _out(df, *columns, digits: int = 9):
    return df.select("ts_id", "open_time", *[F.round(c, digits).alias(c) for c in columns])


def _sql(name: str, columns: dict[str, str], src: str = BASE, frm: str = "x", digits: int = 9):
    return query(name, f"with {src} select ts_id, open_time, " + ", ".join(f'round({v}, {digits}) "{k}"' for k, v in columns.items()) + f" from {frm}")


_LAGS = {f"lag_{k}": f"lag(y, {k}) over ({O})" for k in W.LAGS["1h"]}


@_sql("f01_lags", _LAGS)
def f01(spark, d):
    return _out(W.add_lags(base(spark, d), "y", W.LAGS["1h"]), *_LAGS)


_ROLL = {f"roll_{f}_{n}": f"{g}(y) over {over(n)}" for n in W.WINDOWS["1h"] for f, g in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))}


@_sql("f02_rolling", _ROLL)
def f02(spark, d):
    return _out(W.rolling(base(spark, d), "y", W.WINDOWS["1h"]), *_ROLL)


_MEDIAN = {f"roll_median_{n}": f"median(y) over {over(n)}" for n in W.WINDOWS["1h"]}


@_sql("f03_roll_median", _MEDIAN)
def f03(spark, d):
    return _out(W.rolling(base(spark, d), "y", W.WINDOWS["1h"]), *_MEDIAN)


_SKEW = {f"roll_skew_{n}": f"skewness(y) over {over(n)}" for n in (6, 12, 24)} | {f"roll_kurtosis_{n}": f"kurtosis(y) over {over(n)}" for n in (6, 12, 24)}


@_sql("f04_roll_skew_kurtosis", _SKEW)
def f04(spark, d):
    return _out(W.rolling(base(spark, d), "y", (6, 12, 24)), *_SKEW)


_TREND = {f"rolling_trend_{n}": f"case when {n} / n > 0.15 then -1.0 when count(y) over {over(n)} = {n} then regr_slope(y, i) over {over(n)} end" for n in (3, 24, 168)}
_NUM = f"{BASE}, z as (select *, row_number() over ({O}) i, count(*) over (partition by ts_id)::double n from x)"


@_sql("f05_rolling_trend", _TREND, _NUM, "z")
def f05(spark, d):
    return _out(W.rolling_trend(base(spark, d), "y", (3, 24, 168)), *_TREND)


@_sql("f07_derivatives", {"first_derivative": f"y - lag(y, 1) over ({O})", "second_derivative": f"y - lag(y, 2) over ({O})"})
def f07(spark, d):
    return _out(W.derivatives(base(spark, d), "y"), "first_derivative", "second_derivative")


_RET = f"{BASE}, r as (select *, y / nullif(lag(y) over ({O}), 0) - 1 returns from x)"


@_sql("f08_returns_volatility", {"returns": "returns", "volatility": f"stddev_samp(returns) over {over(12)}"}, _RET, "r")
def f08(spark, d):
    return _out(W.returns(base(spark, d), "y").withColumn("volatility", F.stddev("returns").over(W.rows(12))), "returns", "volatility")


def _features_sql() -> str:
    sizes = W.WINDOWS["1h"]
    cols = {"y": "y"} | _LAGS | _ROLL | _MEDIAN
    cols |= {f"roll_skew_{n}": f"skewness(y) over {over(n)}" for n in sizes if n > 2} | {f"roll_kurtosis_{n}": f"kurtosis(y) over {over(n)}" for n in sizes if n > 3}
    cols |= {f"rolling_trend_{n}": f"case when {n} / n > 0.15 then -1.0 when count(y) over {over(n)} = {n} then regr_slope(y, i) over {over(n)} end" for n in sizes}
    cols |= {"first_derivative": f"y - lag(y, 1) over ({O})", "second_derivative": f"y - lag(y, 2) over ({O})", "returns": "r"}
    cols |= {"volatility": f"stddev_samp(r) over {over(sizes[len(sizes) // 2])}"}
    listed = ", ".join(f'round({v}, 6) "{k}"' for k, v in cols.items())
    complete = " and ".join(f'"{k}" is not null' for k in cols)
    return f"with {_NUM}, q as (select *, y / nullif(lag(y) over ({O}), 0) - 1 r from z), u as (select ts_id, open_time, {listed} from q) select * from u where {complete}"


@query("f09_features_complete", _features_sql())
def f09(spark, d):
    f = W.add_features(base(spark, d), "y", "1h")
    return _out(f, *[c for c in f.columns if c not in ("ts_id", "open_time")], digits=6)


_FILTER = f"{BASE}, m as (select *, median(y) over ({O} rows between 5 preceding and 5 following) med from x), a as (select *, abs(y - med) off from m), b as (select *, median(off) over ({O} rows between 5 preceding and 5 following) mad from a)"


@_sql("f11_rolling_median_filter", {"filtered": "case when mad > 0 and off > 3 * mad then med else y end"}, _FILTER, "b")
def f11(spark, d):
    return _out(W.rolling_median_filter(base(spark, d), "y", 5), "filtered")


_CORR = f"{EVT}, x as (select ts_id, open_time, open a, \"close\" b from candles_evt)"


@_sql("f12_rolling_correlation", {"rolling_corr": f"case when var_samp(a) over {over(50)} > 1e-8 and var_samp(b) over {over(50)} > 1e-8 and count(*) over {over(50)} = 50 then corr(a, b) over {over(50)} end"}, _CORR)
def f12(spark, d):
    c = T.candles_evt(spark, d).select("ts_id", "open_time", F.col("open").alias("a"), F.col("close").alias("b"))
    return _out(W.rolling_correlation(c, "a", "b", 50), "rolling_corr")


@_sql("f14_overlapping_sums", {f"sum_{k}": f"case when count(y) over {over(k)} = {k} then sum(y) over {over(k)} end" for k in (2, 5, 10)})
def f14(spark, d):
    return _out(W.overlapping_sums(base(spark, d), "y", (2, 5, 10)), "sum_2", "sum_5", "sum_10")


@_sql("f15_forward_returns", {f"fwd_{h}": f"lead(y, {h}) over ({O}) / nullif(y, 0) - 1" for h in (1, 5, 10, 20)}, digits=9)
def f15(spark, d):
    return _out(W.forward_returns(base(spark, d), "y"), "fwd_1", "fwd_5", "fwd_10", "fwd_20", digits=9)


@_sql("f16_around", {"pre": f"avg(y) over ({O} rows between 20 preceding and 1 preceding)", "post": f"avg(y) over ({O} rows between 1 following and 20 following)"})
def f16(spark, d):
    a = W.around(base(spark, d), "y", 20)
    mean = lambda c: F.when(F.size(c) > 0, F.aggregate(c, F.lit(0.0), lambda s, x: s + x) / F.size(c))
    return _out(a.withColumns({"pre": mean("pre"), "post": mean("post")}), "pre", "post")


@_sql("f19_cumulative", {"cumulative": f"sum(y) over ({O})"})
def f19(spark, d):
    return _out(W.cumulative(base(spark, d), "y"), "cumulative")


@query(
    "f20_active_version",
    """with p as (select user_id, event_id, ts, event_type <> 'error' active from events)
    select user_id, event_id, active from p qualify row_number() over (partition by user_id order by active desc, ts desc, event_id desc) = 1""",
)
def f20(spark, d):
    from tidegauge.operators.catalog import latest

    e = T.table(spark, d, "events").select("user_id", "event_id", "ts", (F.col("event_type") != "error").alias("active"))
    return latest(e, ["user_id"], F.desc("active"), F.desc("ts"), F.desc("event_id")).select("user_id", "event_id", "active")


_STAT = f"{BASE}, s as (select ts_id, min(y) lo, max(y) hi, avg(y) mu, stddev_pop(y) sd, quantile_cont(y, 0.25) q1, median(y) med, quantile_cont(y, 0.75) q3 from x group by 1), j as (select * from x join s using (ts_id))"


@_sql("m01_minmax", {"scaled": "(y - lo) / case when hi = lo then 1 else hi - lo end"}, _STAT, "j")
def m01a(spark, d):
    return _out(W.scale(base(spark, d), "y", "minmax"), "scaled")


@_sql("m01_standard", {"scaled": "(y - mu) / case when sd = 0 then 1 else sd end"}, _STAT, "j")
def m01b(spark, d):
    return _out(W.scale(base(spark, d), "y", "standard"), "scaled")


@_sql("m01_robust", {"scaled": "(y - med) / case when q3 = q1 then 1 else q3 - q1 end"}, _STAT, "j")
def m01c(spark, d):
    return _out(W.scale(base(spark, d), "y", "robust"), "scaled")


@_sql("m01_log", {"scaled": "ln(1 + abs(y))"})
def m01d(spark, d):
    return _out(W.scale(base(spark, d).withColumn("y", F.abs("y")), "y", "log"), "scaled")


def _poly(x: str, k) -> str:
    out = f"{k[0]!r}"
    for v in k[1:]:
        out = f"({out} * {x} + {v!r})"
    return out


_MID = f"{_poly('(p - 0.5) * (p - 0.5)', W.NORMAL_MIDDLE[0])} * (p - 0.5) / ({_poly('(p - 0.5) * (p - 0.5)', W.NORMAL_MIDDLE[1])} * (p - 0.5) * (p - 0.5) + 1)"
_END = f"{_poly('e', W.NORMAL_TAIL[0])} / ({_poly('e', W.NORMAL_TAIL[1])} * e + 1)"
_RANK = f"{BASE}, pr as (select ts_id, open_time, least(greatest(percent_rank() over (partition by ts_id order by y), 1e-7), 1 - 1e-7) p from x), pe as (select *, sqrt(-2 * ln(case when p < 0.5 then p else 1 - p end)) e from pr)"


@_sql("m01_quantile", {"scaled": f"case when p < 0.02425 then {_END} when p > 1 - 0.02425 then -{_END} else {_MID} end"}, _RANK, "pe", 7)
def m01e(spark, d):
    return _out(W.scale(base(spark, d), "y", "quantile"), "scaled", digits=7)


@_sql("m01_inverse", {"unscaled": "y"})
def m01f(spark, d):
    b = base(spark, d)
    p = W.scaler_parameters(b, "y")
    return _out(W.unscale(W.scale(b, "y", "standard", p), "scaled", "standard", p), "unscaled")


@query(
    "m04_train_test",
    f"""with {BASE}, l as (select *, lag(y, 1) over ({O}) lag_1, lag(y, 2) over ({O}) lag_2 from x), f as (select * from l where lag_1 is not null and lag_2 is not null),
    n as (select *, row_number() over ({O}) <= floor(count(*) over (partition by ts_id) * 0.8) is_train from f),
    e as (select ts_id, min(y) lo, max(y) hi from n where is_train group by 1)
    select ts_id, open_time, round(lag_1, 9) lag_1, round(lag_2, 9) lag_2, is_train, round((y - lo) / case when hi = lo then 1 else hi - lo end, 9) scaled from n join e using (ts_id)""",
)
def m04(spark, d):
    t = W.train_test(base(spark, d), "y", 2)
    return rounded(t.select("ts_id", "open_time", "lag_1", "lag_2", "is_train", "scaled"), "lag_1", "lag_2", "scaled")
