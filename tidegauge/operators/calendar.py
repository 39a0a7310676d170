"""Calendar checks and repairs of regular series: row counts, gaps, duplicates, grids and fills.

Every operator takes and gives long tables keyed by ``ts_id``; one job checks all series. Per-series facts (first and last
time, counts) come from one aggregation that combines before its shuffle.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of an interval; months have calendar arithmetic instead.
INTERVAL_SECONDS = {"1s": 1, "1m": 60, "5m": 300, "15m": 900, "30m": 1800, "1h": 3600, "4h": 14400, "12h": 43200, "1d": 86400, "3d": 259200, "1w": 604800}
#: Rows that a whole month holds; the first three are rows for each day.
ROWS_PER_DAY = {"1h": 24, "12h": 2, "1d": 1}
#: How much one load request of an interval may span.
LOAD_SPANS = {"1h": "INTERVAL 19 DAYS", "12h": "INTERVAL 7 MONTHS", "1d": "INTERVAL 15 MONTHS", "3d": "INTERVAL 45 MONTHS", "1w": "INTERVAL 9 YEARS", "1M": "INTERVAL 40 YEARS"}
NUMERIC = ("open", "high", "low", "close", "volume")


def ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def month_start(c: Column | str) -> Column:
    return ntz(F.date_trunc("month", c))


def interval_of(ts_id: Column | str = "ts_id") -> Column:
    """The interval code at the end of a series id."""
    return F.element_at(F.split(F.col(ts_id) if isinstance(ts_id, str) else ts_id, "_"), -1)


def seconds_between(a: Column, b: Column) -> Column:
    return F.unix_timestamp(ntz(b).cast("timestamp")) - F.unix_timestamp(ntz(a).cast("timestamp"))


def count_months(a: Column, b: Column) -> Column:
    """Calendar months from a to b, both counted."""
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a) + 1


def add_interval(t: Column, code: str) -> Column:
    if code == "1M":
        return ntz(t + F.expr("INTERVAL 1 MONTH"))
    return ntz(t + F.expr(f"INTERVAL {INTERVAL_SECONDS[code]} SECONDS"))


def close_time(open_time: Column, code: str) -> Column:
    """A second before the next bar opens."""
    return ntz(add_interval(open_time, code) - F.expr("INTERVAL 1 SECOND"))


def extremes(df: DataFrame) -> DataFrame:
    return df.groupBy("ts_id").agg(F.min("open_time").alias("min_time"), F.max("open_time").alias("max_time"))


def row_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("ts_id").agg(F.count("open_time").alias("n_rows"))


def expected_rows(month: Column, code: Column) -> Column:
    """Rows of a whole month: by days for 1h, 12h and 1d; 9 or 10 for 3d; 4 for 1w; 1 for 1M."""
    days = F.dayofmonth(F.last_day(month))
    out = F.when(code == "3d", F.when(F.month(month) == 2, 9).otherwise(10)).when(code == "1w", 4).when(code == "1M", 1)
    for c, n in ROWS_PER_DAY.items():
        out = out.when(code == c, days * n)
    return out


def monthly_counts(df: DataFrame, as_of: datetime | None = None, partial_first: bool = False) -> DataFrame:
    """Rows of each whole month: after the first month and before that of ``as_of`` (else of the series' last row).

    ``leap`` is the number of days of a February, else null. With ``partial_first`` the first month counts too.
    """
    counts = df.groupBy("ts_id", month_start("open_time").alias("month")).agg(F.count(F.lit(1)).alias("rows_amount"))
    ends = extremes(df)
    last = F.lit(as_of).cast("timestamp_ntz") if as_of else F.col("max_time")
    first = month_start("min_time")
    counts = counts.join(ends, "ts_id").where(F.col("month") < month_start(last))
    counts = counts.where(F.col("month") >= first if partial_first else F.col("month") > first)
    leap = F.when(F.month("month") == 2, F.dayofmonth(F.last_day("month")))
    return counts.select("ts_id", "month", "rows_amount", F.month("month").alias("month_number"), leap.alias("leap"))


def lacks(df: DataFrame, as_of: datetime | None = None, partial_first: bool = False) -> DataFrame:
    """Months that hold fewer rows than they should."""
    m = monthly_counts(df, as_of, partial_first)
    m = m.where(F.col("rows_amount") < expected_rows(F.col("month"), interval_of()))
    return m.select("ts_id", F.col("month").alias("month_where_lacks"), "rows_amount")


def new_lacks(found: DataFrame, known: DataFrame) -> DataFrame:
    return found.join(known, ["ts_id", "month_where_lacks", "rows_amount"], "left_anti")


def merge_lacks(found: DataFrame, known: DataFrame) -> DataFrame:
    return known.select(*found.columns).unionByName(new_lacks(found, known)).orderBy("ts_id", "month_where_lacks")


def continuity(df: DataFrame) -> DataFrame:
    """Expected and actual rows of each series and how far they differ."""
    s = df.groupBy("ts_id").agg(F.min("open_time").alias("lo"), F.max("open_time").alias("hi"), F.count(F.lit(1)).alias("actual"))
    code = interval_of()
    seconds = F.create_map(*[F.lit(x) for kv in INTERVAL_SECONDS.items() for x in kv])[code]
    expected = F.when(code == "1M", count_months(F.col("lo"), F.col("hi"))).otherwise(F.floor(seconds_between(F.col("lo"), F.col("hi")) / seconds) + 1)
    s = s.withColumn("expected", expected.cast("long"))
    return s.select("ts_id", "expected", "actual", F.abs(F.col("actual") - F.col("expected")).alias("difference"))


def duplicates(df: DataFrame) -> DataFrame:
    return df.groupBy("ts_id", "open_time").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def drop_duplicates(df: DataFrame, *order: str) -> DataFrame:
    """One row for each series and time: the first by ``order``; a window whose rank limit is applied before the shuffle."""
    w = Window.partitionBy("ts_id", "open_time").orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def grid(df: DataFrame, code: str) -> DataFrame:
    """Every time from a series' first row to its last: months start on the first, weeks on Mondays."""
    lo, hi = F.col("min_time"), F.col("max_time")
    if code == "1M":
        lo, step = month_start(lo), "INTERVAL 1 MONTH"
    elif code == "1w":
        monday = ntz(F.date_trunc("week", lo))
        lo, step = F.when(monday < lo, ntz(monday + F.expr("INTERVAL 7 DAYS"))).otherwise(monday), "INTERVAL 7 DAYS"
    else:
        step = f"INTERVAL {INTERVAL_SECONDS[code]} SECONDS"
    ends = extremes(df).withColumn("min_time", lo).where(F.col("min_time") <= F.col("max_time"))
    return ends.select("ts_id", F.explode(F.sequence(F.col("min_time"), hi, F.expr(step))).alias("open_time"))


def around(known: Column, by: str) -> tuple[Column, Column]:
    """The nearest ``known`` value at or before a row and at or after it, null where there is none.

    Both look back, in one order and in its reverse: a window that looks ahead to the end would be evaluated anew over the
    rest of the series for every row.
    """
    w = Window.partitionBy("ts_id")
    back, ahead = (w.orderBy(order).rowsBetween(Window.unboundedPreceding, 0) for order in (F.asc(by), F.desc(by)))
    return F.last(known, ignorenulls=True).over(back), F.last(known, ignorenulls=True).over(ahead)


def interpolate_time(df: DataFrame, columns, by: str = "open_time") -> DataFrame:
    """Linear interpolation by time; after the last known value that value holds; before the first stays null."""
    ends = {}
    for c in columns:
        known = F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col(by).alias("t")))
        ends[f"_0{c}"], ends[f"_1{c}"] = around(known, by)
    df, out = df.withColumns(ends), {}
    for c in columns:
        before, after = F.col(f"_0{c}"), F.col(f"_1{c}")
        span, part = seconds_between(before["t"], after["t"]), seconds_between(before["t"], F.col(by))
        line = before["v"] + (after["v"] - before["v"]) * part / span
        out[c] = F.when(F.col(c).isNotNull(), F.col(c)).when(after.isNull(), before["v"]).otherwise(line)
    return df.withColumns(out).drop(*ends)


def gap_fill(df: DataFrame, code: str, columns=NUMERIC) -> DataFrame:
    """Only the rows that the grid has and the series lacks, interpolated, with their close time and source."""
    full = grid(df, code).join(df.withColumn("_known", F.lit(True)), ["ts_id", "open_time"], "left")
    full = interpolate_time(full, (*columns, "number_of_trades"))
    new = full.where(F.col("_known").isNull())
    return new.select(
        "ts_id", "open_time", *columns, F.col("number_of_trades").cast("long").alias("number_of_trades"),
        close_time(F.col("open_time"), code).alias("close_time"), F.lit("interpolated").alias("source"),
    )


def interpolate_rows(df: DataFrame, column: str) -> DataFrame:
    """Linear by row position, then the nearest known value before the first and after the last."""
    df = df.withColumn("_i", F.row_number().over(Window.partitionBy("ts_id").orderBy("open_time")))
    known = F.when(F.col(column).isNotNull(), F.struct(F.col(column).alias("v"), F.col("_i").alias("i")))
    before, after = around(known, "open_time")
    df = df.withColumns({"_0": before, "_1": after})
    line = line_between(F.col("_0"), F.col("_1"), F.col("_i"))
    return df.withColumn(column, F.coalesce(F.col(column), line, F.col("_0")["v"], F.col("_1")["v"])).drop("_i", "_0", "_1")


def line_between(before: Column, after: Column, i: Column) -> Column:
    """The value at place ``i`` on the line between two known ``(v, i)``; null where they are one."""
    span = after["i"] - before["i"]
    return before["v"] + (after["v"] - before["v"]) * (i - before["i"]) / F.when(span != 0, span)


def forward_fill(df: DataFrame, column: str, limit: int) -> DataFrame:
    w = Window.partitionBy("ts_id").orderBy("open_time").rowsBetween(-limit, 0)
    return df.withColumn(column, F.last(column, ignorenulls=True).over(w))


def freshness(df: DataFrame, as_of: datetime) -> DataFrame:
    """Whether the last row is of the current hour (1h) or day (1d); other intervals count as fresh."""
    now, code = F.lit(as_of).cast("timestamp_ntz"), interval_of()
    due = F.when(code == "1h", ntz(F.date_trunc("hour", now))).when(code == "1d", ntz(F.date_trunc("day", now)))
    s = extremes(df)
    return s.select("ts_id", "max_time", F.when(due.isNull(), F.lit(True)).otherwise(F.col("max_time") == due).alias("is_fresh"))


def quality_report(df: DataFrame, as_of: datetime) -> DataFrame:
    """One row for each series: freshness, continuity, number of lacking months, of repeated times; whether a fill is due."""
    lack = lacks(df).groupBy("ts_id").agg(F.count(F.lit(1)).alias("n_lacks"))
    twice = duplicates(df).groupBy("ts_id").agg(F.count(F.lit(1)).alias("n_duplicates"))
    out = freshness(df, as_of).join(continuity(df), "ts_id").join(lack, "ts_id", "left").join(twice, "ts_id", "left")
    out = out.fillna(0, ["n_lacks", "n_duplicates"])
    return out.select("ts_id", "max_time", "is_fresh", "expected", "actual", "difference", "n_lacks", "n_duplicates", ((F.col("difference") > 0) | (F.col("n_lacks") > 0)).alias("needs_fill"))


def repaired(df: DataFrame, code: str, as_of: datetime | None = None) -> DataFrame:
    """Each time once, and series that have gaps or lacking months filled."""
    once = df.dropDuplicates(["ts_id", "open_time"])
    report = quality_report(once, as_of or datetime(1970, 1, 1)).where("needs_fill").select("ts_id")
    return once.unionByName(gap_fill(once.join(report, "ts_id", "left_semi"), code), allowMissingColumns=True)


def check(df: DataFrame, ts_id: str, as_of: datetime) -> tuple[DataFrame | None, str | None]:
    """``(report, error)`` of one series, as callers of a facade expect: one of the two is None."""
    code = ts_id.rsplit("_", 1)[-1]
    if code not in (*INTERVAL_SECONDS, "1M"):
        return None, f"no interval {code!r}"
    mine = df.where(F.col("ts_id") == ts_id)
    return (None, f"no rows of {ts_id!r}") if mine.isEmpty() else (quality_report(mine, as_of), None)


def load_windows(spans: DataFrame, code: str) -> DataFrame:
    """``spans(ts_id, start, stop)`` cut so that a request stays small; each window ends on a day's last second."""
    starts = spans.select("ts_id", "start", "stop", F.explode(F.sequence("start", "stop", F.expr(LOAD_SPANS[code]))).alias("window_start"))
    after = ntz(F.date_trunc("day", F.col("window_start") + F.expr(LOAD_SPANS[code])))
    end = F.least(F.col("stop"), ntz(after - F.expr("INTERVAL 1 SECOND")))
    begin = F.when(F.col("window_start") == F.col("start"), F.col("start")).otherwise(ntz(F.date_trunc("day", "window_start")))
    return starts.select("ts_id", begin.alias("window_start"), end.alias("window_end")).where("window_start <= window_end")


def next_start(df: DataFrame, series: DataFrame, default: datetime = datetime(2015, 1, 1)) -> DataFrame:
    """Where each series' next load starts: a second after its last row, or at the default."""
    high = df.groupBy("ts_id").agg(F.max("open_time").alias("hi"))
    start = F.coalesce(ntz(F.col("hi") + F.expr("INTERVAL 1 SECOND")), F.lit(default).cast("timestamp_ntz"))
    return series.select("ts_id").join(high, "ts_id", "left").select("ts_id", start.alias("start"))


def replace_range(old: DataFrame, new: DataFrame) -> DataFrame:
    """Idempotent load: rows of ``old`` within the new rows' span, ends included, give way."""
    span = new.groupBy("ts_id").agg(F.min("open_time").alias("_a"), F.max("open_time").alias("_b"))
    kept = old.join(span, "ts_id", "left").where(F.col("_a").isNull() | ~F.col("open_time").between(F.col("_a"), F.col("_b")))
    return kept.select(*old.columns).unionByName(new.select(*old.columns))
