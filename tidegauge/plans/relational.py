"""Scans, casts, calendar checks, joins and set operations as queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegauge.operators import calendar as C
from tidegauge.operators import joins as J
from tidegauge.plans.registry import query
from tidegauge.sources import scans as S
from tidegauge.sources import tables as T

EVT, ORD = T.CANDLES_EVT_SQL, T.CANDLES_ORD_SQL
AS_OF = datetime(2024, 1, 30, 23, 57)
ENDS = "ends as (select ts_id, min(open_time) lo, max(open_time) hi from {t} group by 1)"
MONTHS = f"""{ORD}, {ENDS.format(t='candles_ord')},
m as (select c.ts_id, cast(date_trunc('month', open_time) as timestamp) as month, cast(count(*) as bigint) rows_amount, min(lo) lo, min(hi) hi
      from candles_ord c join ends using (ts_id) group by 1, 2)"""


def rounded(df, *columns):
    """Round so that both engines' last bits don't matter."""
    return df.withColumns({c: F.round(c, 9) for c in columns})


# --- scans -----------------------------------------------------------------------------------------------------------


@query("a02_full_scan", f"with {EVT} select ts_id, open_time, round(open, 9) open, round(close, 9) \"close\" from candles_evt")
def a02(spark, d):
    return rounded(S.full_scan(T.candles_evt(spark, d)).select("ts_id", "open_time", "open", "close"), "open", "close")


@query("a03_time_range", f"with {EVT} select ts_id, open_time, round(open, 9) open from candles_evt where open_time >= timestamp '2024-01-05' and open_time < timestamp '2024-01-08'")
def a03(spark, d):
    return rounded(S.time_range(T.candles_evt(spark, d), datetime(2024, 1, 5), datetime(2024, 1, 8)).select("ts_id", "open_time", "open"), "open")


@query("a04_catalogue", f"with {EVT} select ts_id, split_part(ts_id, '_', 1) instrument_type, split_part(ts_id, '_', 2) currency, split_part(ts_id, '_', 3) interval_code, true is_active from (select distinct ts_id from candles_evt)")
def a04(spark, d):
    return S.catalogue(T.candles_evt(spark, d)).where("is_active")


@query("a06_currencies", f"with {EVT} select distinct split_part(ts_id, '_', 2) currency from candles_evt")
def a06(spark, d):
    return S.catalogue(T.candles_evt(spark, d)).select("currency").distinct()


@query(
    "a13_replace_range",
    f"""with {EVT}, new as (select ts_id, open_time, -1.0::double open from candles_evt where open_time between timestamp '2024-01-10' and timestamp '2024-01-12' and hour(open_time) % 2 = 0),
    s as (select ts_id, min(open_time) a, max(open_time) b from new group by 1)
    select c.ts_id, c.open_time, round(c.open, 9) open from candles_evt c left join s using (ts_id) where a is null or open_time not between a and b
    union all select ts_id, open_time, open from new""",
)
def a13(spark, d):
    c = T.candles_evt(spark, d).select("ts_id", "open_time", "open")
    span = F.col("open_time").between(F.lit(datetime(2024, 1, 10)).cast("timestamp_ntz"), F.lit(datetime(2024, 1, 12)).cast("timestamp_ntz"))
    new = c.where(span & (F.hour("open_time") % 2 == 0)).withColumn("open", F.lit(-1.0))
    return rounded(C.replace_range(c, new), "open")


@query("a22_train_scan", f"with {EVT} select ts_id, open_time, round(open, 9) open from candles_evt where ts_id = 'crypto_view_1h'")
def a22(spark, d):
    return rounded(S.one_series(T.candles_evt(spark, d), "view", "1h").select("ts_id", "open_time", "open"), "open")


# --- casts -----------------------------------------------------------------------------------------------------------


@query(
    "b01_kline_transform",
    """select 'view_1h' ts_id, epoch_ms(cast(epoch_ms(ts) as bigint)) open_time, cast(value as double) open, cast(event_id as varchar) number_of_trades, 'landing' source
    from (select event_id, date_trunc('second', ts) ts, value from events where event_type = 'view')""",
)
def b01(spark, d):
    e = T.table(spark, d, "events").where("event_type = 'view'")
    raw = e.select(
        F.unix_millis(F.date_trunc("second", "ts")).alias("open_ms"), F.col("value").cast("string").alias("open"), F.col("event_id").alias("trades")
    )
    return S.kline_rows(raw, "view_1h", "landing")


@query("b02_to_numeric", "select event_id, try_cast(replace(cast(event_type as varchar) || cast(event_id % 3 as varchar), 'view', '') as double) x from events")
def b02(spark, d):
    text = F.replace(F.concat("event_type", (F.col("event_id") % 3).cast("string")), F.lit("view"), F.lit(""))
    return T.table(spark, d, "events").select("event_id", S.to_number(text).alias("x"))


@query("b03_to_time", "select event_id, try_cast(case when event_id % 2 = 0 then strftime(ts, '%Y-%m-%d %H:%M:%S') else 'no time' end as timestamp) t from events")
def b03(spark, d):
    text = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise("no time")
    return T.table(spark, d, "events").select("event_id", S.to_time(text).alias("t"))


@query("b04_close_time", f"with {EVT} select ts_id, open_time, cast(open_time + interval 3600 second - interval 1 second as timestamp) close_time from candles_evt")
def b04(spark, d):
    return T.candles_evt(spark, d).select("ts_id", "open_time", C.close_time(F.col("open_time"), "1h").alias("close_time"))


@query("b04_close_time_month", "select distinct cast(date_trunc('month', o_orderdate) as timestamp) m, cast(date_trunc('month', o_orderdate) + interval 1 month - interval 1 second as timestamp) close_time from orders")
def b04m(spark, d):
    m = T.table(spark, d, "orders").select(C.month_start("o_orderdate").alias("m")).distinct()
    return m.select("m", C.close_time(F.col("m"), "1M").alias("close_time"))


@query(
    "b08_market_hours",
    f"""with {EVT}, l as (select ts_id, open_time, timezone('America/New_York', timezone('UTC', open_time)) t from candles_evt)
    select ts_id, open_time, (strftime(t, '%H:%M') >= '09:30' and strftime(t, '%H:%M') < '16:00' and isodow(t) < 6) is_open from l""",
)
def b08(spark, d):
    c = T.candles_evt(spark, d)
    return c.select("ts_id", "open_time", S.market_open(F.col("open_time"), "stock").alias("is_open"))


@query("b10_parse_periods", "select distinct event_type, [24, 168] periods from events")
def b10(spark, d):
    e = T.table(spark, d, "events").select("event_type").distinct()
    return e.select("event_type", F.from_json(F.lit("[24, 168]"), "array<int>").alias("periods"))


@query("b11_epoch_ms", f"with {EVT} select ts_id, open_time, cast(epoch_ms(open_time) as bigint) ms from candles_evt")
def b11(spark, d):
    return T.candles_evt(spark, d).select("ts_id", "open_time", F.unix_millis(F.col("open_time").cast("timestamp")).alias("ms"))


# --- calendar --------------------------------------------------------------------------------------------------------


@query("c01_extreme_dates", f"with {ORD} select ts_id, min(open_time) min_time, max(open_time) max_time from candles_ord group by 1")
def c01(spark, d):
    return C.extremes(T.candles_ord(spark, d))


@query("c02_row_count", f"with {ORD} select ts_id, cast(count(open_time) as bigint) n_rows from candles_ord group by 1")
def c02(spark, d):
    return C.row_counts(T.candles_ord(spark, d))


@query("c03_monthly_counts", f"with {MONTHS} select ts_id, month, rows_amount, cast(month(month) as int) month_number, cast(case when month(month) = 2 then day(last_day(month)) end as double) leap from m where month > date_trunc('month', lo) and month < date_trunc('month', hi)")
def c03(spark, d):
    return C.monthly_counts(T.candles_ord(spark, d)).withColumn("leap", F.col("leap").cast("double"))


@query("c04_expected_rows", "select distinct cast(date_trunc('month', o_orderdate) as timestamp) m, cast(day(last_day(o_orderdate)) * 24 as int) h1, cast(case when month(o_orderdate) = 2 then 9 else 10 end as int) d3 from orders")
def c04(spark, d):
    m = T.table(spark, d, "orders").select(C.month_start("o_orderdate").alias("m")).distinct()
    return m.select("m", C.expected_rows(F.col("m"), F.lit("1h")).alias("h1"), C.expected_rows(F.col("m"), F.lit("3d")).alias("d3"))


@query("c05_lacks", f"with {MONTHS} select ts_id, month month_where_lacks, rows_amount from m where month > date_trunc('month', lo) and month < date_trunc('month', hi) and rows_amount < day(last_day(month))")
def c05(spark, d):
    return C.lacks(T.candles_ord(spark, d))


@query("c06_lacks_with_first_month", f"with {MONTHS} select ts_id, month month_where_lacks, rows_amount from m where month < date_trunc('month', hi) and rows_amount < day(last_day(month))")
def c06(spark, d):
    return C.lacks(T.candles_ord(spark, d), partial_first=True)


_LACKS = f"{MONTHS}, l as (select ts_id, month month_where_lacks, rows_amount from m where month > date_trunc('month', lo) and month < date_trunc('month', hi) and rows_amount < day(last_day(month)))"


@query("c07_new_lacks", f"with {_LACKS} select * from l where not (year(month_where_lacks) < 1998)")
def c07(spark, d):
    found = C.lacks(T.candles_ord(spark, d))
    return C.new_lacks(found, found.where(F.year("month_where_lacks") < 1998))


@query("c08_merge_lacks", f"with {_LACKS} select * from l")
def c08(spark, d):
    found = C.lacks(T.candles_ord(spark, d))
    return C.merge_lacks(found, found.where(F.year("month_where_lacks") < 1998))


@query("c09_continuity", f"with {EVT}, {ENDS.format(t='candles_evt')} select ts_id, cast(date_diff('second', lo, hi) // 3600 + 1 as bigint) expected, n actual, abs(n - (date_diff('second', lo, hi) // 3600 + 1)) difference from ends join (select ts_id, cast(count(*) as bigint) n from candles_evt group by 1) using (ts_id)")
def c09(spark, d):
    return C.continuity(T.candles_evt(spark, d))


@query("c10_month_count", f"with {ORD}, {ENDS.format(t='candles_ord')} select ts_id, cast((year(hi) - year(lo)) * 12 + month(hi) - month(lo) + 1 as int) as months from ends")
def c10(spark, d):
    return C.extremes(T.candles_ord(spark, d)).select("ts_id", C.count_months(F.col("min_time"), F.col("max_time")).alias("months"))


_TWICE = "e as (select 'crypto_'||event_type||'_1h' ts_id, cast(date_trunc('hour', ts) as timestamp) open_time, event_id, value from events)"


def _twice(spark, d):
    e = T.table(spark, d, "events")
    return e.select(F.concat(F.lit("crypto_"), "event_type", F.lit("_1h")).alias("ts_id"), C.ntz(F.date_trunc("hour", "ts")).alias("open_time"), "event_id", "value")


@query("c11_duplicates", f"with {_TWICE} select ts_id, open_time, cast(count(*) as bigint) n from e group by 1, 2 having count(*) > 1")
def c11(spark, d):
    return C.duplicates(_twice(spark, d))


@query("c12_drop_duplicates", f"with {_TWICE} select ts_id, open_time, event_id, value from e qualify row_number() over (partition by ts_id, open_time order by event_id) = 1")
def c12(spark, d):
    return C.drop_duplicates(_twice(spark, d), "event_id")


_GRID = f"{EVT}, {ENDS.format(t='candles_evt')}, grid as (select ts_id, unnest(generate_series(lo, hi, interval 1 hour)) open_time from ends)"


@query("c13_grid", f"with {_GRID} select ts_id, cast(open_time as timestamp) open_time from grid")
def c13(spark, d):
    return C.grid(T.candles_evt(spark, d), "1h")


@query("c13_grid_weeks", f"with {ORD}, {ENDS.format(t='candles_ord')}, w as (select ts_id, hi, case when date_trunc('week', lo) < lo then date_trunc('week', lo) + interval 7 day else date_trunc('week', lo) end lo from ends) select ts_id, cast(unnest(generate_series(cast(lo as timestamp), hi, interval 7 day)) as timestamp) open_time from w")
def c13w(spark, d):
    return C.grid(T.candles_ord(spark, d), "1w")


@query("c13_grid_months", f"with {ORD}, {ENDS.format(t='candles_ord')} select ts_id, cast(unnest(generate_series(cast(date_trunc('month', lo) as timestamp), hi, interval 1 month)) as timestamp) open_time from ends")
def c13m(spark, d):
    return C.grid(T.candles_ord(spark, d), "1M")


def _line(c):
    return f"""round(v0_{c} + (coalesce(v1_{c}, v0_{c}) - v0_{c}) * coalesce(date_diff('second', t0, open_time) / nullif(date_diff('second', t0, t1), 0)::double, 0), 9) "{c}\""""


_AROUND = ", ".join(f'last_value("{c}" ignore nulls) over b v0_{c}, first_value("{c}" ignore nulls) over a v1_{c}' for c in C.NUMERIC)


@query(
    "c14_gap_fill",
    f"""with {_GRID}, f as (select g.ts_id, cast(g.open_time as timestamp) open_time, c.ts_id is null missing, c.open_time known, open, high, low, "close", volume, number_of_trades
      from grid g left join candles_evt c on c.ts_id = g.ts_id and c.open_time = g.open_time),
    w as (select ts_id, open_time, missing, last_value(known ignore nulls) over b t0, first_value(known ignore nulls) over a t1, {_AROUND},
      last_value(number_of_trades ignore nulls) over b n0, first_value(number_of_trades ignore nulls) over a n1 from f
      window b as (partition by ts_id order by open_time rows between unbounded preceding and current row), a as (partition by ts_id order by open_time rows between current row and unbounded following))
    select ts_id, open_time, {', '.join(_line(c) for c in C.NUMERIC)}, cast(trunc(n0 + (n1 - n0) * (date_diff('second', t0, open_time) / date_diff('second', t0, t1)::double)) as bigint) number_of_trades,
      cast(open_time + interval 3599 second as timestamp) close_time, 'interpolated' source from w where missing""",
)
def c14(spark, d):
    return rounded(C.gap_fill(T.candles_evt(spark, d), "1h"), *C.NUMERIC)


@query("c15_freshness", f"with {EVT} select ts_id, max(open_time) max_time, max(open_time) = timestamp '2024-01-30 23:00:00' is_fresh from candles_evt group by 1")
def c15(spark, d):
    return C.freshness(T.candles_evt(spark, d), AS_OF)


@query(
    "c16_quality_report",
    f"""with {EVT}, {ENDS.format(t='candles_evt')},
    n as (select ts_id, cast(count(*) as bigint) actual from candles_evt group by 1),
    m as (select c.ts_id, date_trunc('month', open_time) mo, count(*) k from candles_evt c join ends using (ts_id) where open_time >= date_trunc('month', lo) + interval 1 month and open_time < date_trunc('month', hi) group by 1, 2),
    l as (select ts_id, cast(count(*) as bigint) n_lacks from m where k < 24 * day(last_day(mo)) group by 1),
    t as (select ts_id, cast(count(*) as bigint) n_duplicates from (select ts_id, open_time from candles_evt group by 1, 2 having count(*) > 1) group by 1),
    r as (select ts_id, hi max_time, hi = timestamp '2024-01-30 23:00:00' is_fresh, cast(date_diff('second', lo, hi) // 3600 + 1 as bigint) expected, actual, coalesce(n_lacks, 0) n_lacks, coalesce(n_duplicates, 0) n_duplicates
      from ends join n using (ts_id) left join l using (ts_id) left join t using (ts_id))
    select *, abs(actual - expected) difference, actual <> expected or n_lacks > 0 needs_fill from r""",
)
def c16(spark, d):
    return C.quality_report(T.candles_evt(spark, d), AS_OF)


@query(
    "c18_load_windows",
    f"""with {ORD}, {ENDS.format(t='candles_ord')}, s as (select ts_id, cast(lo as timestamp) a, cast(hi as timestamp) b, unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 15 month)) ws from ends),
    w as (select ts_id, case when ws = a then a else cast(date_trunc('day', ws) as timestamp) end window_start, least(b, cast(date_trunc('day', ws + interval 15 month) - interval 1 second as timestamp)) window_end from s)
    select * from w where window_start <= window_end""",
)
def c18(spark, d):
    spans = C.extremes(T.candles_ord(spark, d)).select("ts_id", F.col("min_time").alias("start"), F.col("max_time").alias("stop"))
    return C.load_windows(spans, "1d")


@query("c19_next_start", f"with {EVT} select ts_id, cast(max(open_time) + interval 1 second as timestamp) \"start\" from candles_evt where ts_id <> 'crypto_view_1h' group by 1 union all select 'crypto_view_1h', timestamp '2015-01-01'")
def c19(spark, d):
    c = T.candles_evt(spark, d)
    return C.next_start(c.where("ts_id <> 'crypto_view_1h'"), c.select("ts_id").distinct())


@query("c20_dashboard_sum", f"with {EVT} select open_time, round(sum(open), 9) total from candles_evt group by 1")
def c20(spark, d):
    return rounded(T.candles_evt(spark, d).groupBy("open_time").agg(F.sum("open").alias("total")), "total").orderBy("open_time")


_HOLES = f"{EVT}, h as (select ts_id, open_time, case when hour(open_time) % 5 = 0 then null else open end x, row_number() over (partition by ts_id order by open_time) i from candles_evt)"


def _holes(spark, d):
    return T.candles_evt(spark, d).select("ts_id", "open_time", F.when(F.hour("open_time") % 5 != 0, F.col("open")).alias("x"))


@query(
    "c21_interpolate_rows",
    f"""with {_HOLES}, w as (select *, last_value(x ignore nulls) over b v0, first_value(x ignore nulls) over a v1, last_value(case when x is not null then i end ignore nulls) over b i0,
      first_value(case when x is not null then i end ignore nulls) over a i1 from h
      window b as (partition by ts_id order by open_time rows between unbounded preceding and current row), a as (partition by ts_id order by open_time rows between current row and unbounded following))
    select ts_id, open_time, round(case when x is not null then x else coalesce(v0 + (v1 - v0) * (i - i0) / (i1 - i0), v0, v1) end, 9) x from w""",
)
def c21(spark, d):
    return rounded(C.interpolate_rows(_holes(spark, d), "x"), "x")


@query("c22_forward_fill", f"with {_HOLES} select ts_id, open_time, round(last_value(x ignore nulls) over (partition by ts_id order by open_time rows between 5 preceding and current row), 9) x from h")
def c22(spark, d):
    return rounded(C.forward_fill(_holes(spark, d), "x", 5), "x")


# --- joins -----------------------------------------------------------------------------------------------------------


@query("d01_full_outer", f"with {_GRID} select g.ts_id, cast(g.open_time as timestamp) open_time, round(open, 9) open from grid g left join candles_evt c on c.ts_id = g.ts_id and c.open_time = g.open_time")
def d01(spark, d):
    c = T.candles_evt(spark, d)
    return rounded(C.grid(c, "1h").join(c.select("ts_id", "open_time", "open"), ["ts_id", "open_time"], "full"), "open")


@query("d04_two_keys", "select o_orderkey, l_linenumber, round(l_quantity, 9) q from orders join lineitem on l_orderkey = o_orderkey and l_shipdate = o_orderdate")
def d04(spark, d):
    o, li = T.table(spark, d, "orders"), T.table(spark, d, "lineitem")
    return rounded(o.join(li, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") == F.col("o_orderdate"))).select("o_orderkey", "l_linenumber", F.col("l_quantity").alias("q")), "q")


@query("d06_align_series", f"with {EVT} select c.ts_id, c.open_time, round(c.close, 9) target, round(r.close, 9) reference from candles_evt c join candles_evt r on r.open_time = c.open_time and r.ts_id = 'crypto_view_1h' where c.ts_id <> 'crypto_view_1h'")
def d06(spark, d):
    return rounded(J.align(T.candles_evt(spark, d), "crypto_view_1h", "close"), "target", "reference")


@query("d07_common_times", f"with {EVT} select open_time from candles_evt where ts_id = 'crypto_view_1h' intersect select open_time from candles_evt where ts_id = 'crypto_click_1h'")
def d07(spark, d):
    c = T.candles_evt(spark, d)
    return c.where("ts_id = 'crypto_view_1h'").select("open_time").intersect(c.where("ts_id = 'crypto_click_1h'").select("open_time"))


_NUMBERED = f"{EVT}, n as (select ts_id, open_time, close, row_number() over (partition by ts_id order by open_time) i from candles_evt), ev as (select ts_id, open_time event_time, i ei from n where hour(open_time) = 12)"


@query("d08_row_window", f"with {_NUMBERED} select ev.ts_id, event_time, cast(i - ei as int) \"offset\", round(close, 9) value from ev join n on n.ts_id = ev.ts_id and n.i between ei - 3 and ei + 3")
def d08(spark, d):
    c = T.candles_evt(spark, d)
    return rounded(J.row_window(c, F.hour("open_time") == 12, "close", 3), "value")


@query("d09_exact_lookup", f"with {EVT} select event_id, round(c.close, 9) price from events e join candles_evt c on c.ts_id = 'crypto_'||e.event_type||'_1h' and c.open_time = date_trunc('hour', e.ts)")
def d09(spark, d):
    e = _twice(spark, d).select("ts_id", "open_time", "event_id")
    return rounded(e.join(T.candles_evt(spark, d), ["ts_id", "open_time"]).select("event_id", F.col("close").alias("price")), "price")


@query("d12_correlated_minimum", f"with {ORD}, {ENDS.format(t='candles_ord')} select ts_id, cast(count(*) as bigint) n from candles_ord join ends using (ts_id) where open_time >= lo + interval 1 month group by 1")
def d12(spark, d):
    c = T.candles_ord(spark, d)
    ends = C.extremes(c).select("ts_id", "min_time")
    late = c.join(ends, "ts_id").where(F.col("open_time") >= F.col("min_time") + F.expr("INTERVAL 1 MONTH"))
    return late.groupBy("ts_id").agg(F.count(F.lit(1)).alias("n"))


@query("dx_asof", f"with {EVT} select e.event_id, round(c.close, 9) value from (select * from events where event_type = 'error') e asof left join (select * from candles_evt where ts_id = 'crypto_view_1h') c on e.ts >= c.open_time")
def dx_asof(spark, d):
    e = T.table(spark, d, "events").where("event_type = 'error'").select("event_id", F.col("ts").alias("open_time"), F.lit("crypto_view_1h").alias("ts_id"))
    c = T.candles_evt(spark, d).where("ts_id = 'crypto_view_1h'").select("ts_id", "open_time", F.col("close").alias("value"))
    return rounded(J.as_of(e, c, "value").select("event_id", "value"), "value")


@query("dx_range_join", f"with {EVT}, s as (select event_id, ts a, ts + interval 5 hour b from events where event_type = 'signup') select event_id, cast(count(*) as bigint) n from s join candles_evt c on c.ts_id = 'crypto_view_1h' and c.open_time between a and b group by 1")
def dx_range(spark, d):
    spans = T.table(spark, d, "events").where("event_type = 'signup'").select("event_id", F.col("ts").alias("a"), C.ntz(F.col("ts") + F.expr("INTERVAL 5 HOURS")).alias("b"))
    points = T.candles_evt(spark, d).where("ts_id = 'crypto_view_1h'").select("open_time")
    return J.range_join(spans, points, "a", "b", "open_time", 6 * 3600).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))


# --- order, limits, sets ---------------------------------------------------------------------------------------------


@query("g04_top_one", f"with {EVT} select ts_id, arg_max(open_time, (volume, open_time)) open_time from candles_evt group by 1")
def g04(spark, d):
    return T.candles_evt(spark, d).groupBy("ts_id").agg(F.max_by("open_time", F.struct("volume", "open_time")).alias("open_time"))


@query("g05_top_k_deviant", f"with {EVT}, x as (select ts_id, open_time, abs(close - avg(close) over (partition by ts_id)) dev from candles_evt) select ts_id, open_time, round(dev, 9) dev from x qualify row_number() over (partition by ts_id order by dev desc, open_time) <= 10")
def g05(spark, d):
    c = T.candles_evt(spark, d)
    mean = c.groupBy("ts_id").agg(F.avg("close").alias("mu"))
    c = c.join(mean, "ts_id").select("ts_id", "open_time", F.abs(F.col("close") - F.col("mu")).alias("dev"))
    w = Window.partitionBy("ts_id").orderBy(F.desc("dev"), "open_time")
    return rounded(c.withColumn("rn", F.row_number().over(w)).where("rn <= 10").drop("rn"), "dev")


@query("g07_distinct", "select distinct event_type from events")
def g07(spark, d):
    return T.table(spark, d, "events").select("event_type").distinct()


@query("g08_difference", f"with {_GRID} select ts_id, cast(open_time as timestamp) open_time from grid except select ts_id, open_time from candles_evt")
def g08(spark, d):
    c = T.candles_evt(spark, d)
    return C.grid(c, "1h").exceptAll(c.select("ts_id", "open_time"))


@query("g09_last_five", f"with {_LACKS} select ts_id, array_to_string(list(strftime(month_where_lacks, '%Y-%m') order by month_where_lacks)[-5:], ',') as months from l group by 1")
def g09(spark, d):
    found = C.lacks(T.candles_ord(spark, d)).groupBy("ts_id").agg(F.sort_array(F.collect_list("month_where_lacks")).alias("m"))
    return found.select("ts_id", F.when(F.size("m") > 5, F.slice("m", -5, 5)).otherwise(F.col("m")).alias("m")).select("ts_id", F.array_join(F.transform("m", lambda t: F.date_format(t, "yyyy-MM")), ",").alias("months"))
