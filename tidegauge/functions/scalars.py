"""Scalar rules: classes of length and frequency, heuristics by interval, staleness, holidays, array thinning."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Least length of each class; frequency of each interval.
LENGTHS = (("TINY", 0), ("SHORT", 20), ("SMALL", 100), ("MEDIUM", 500), ("LARGE", 2000), ("HUGE", 10000), ("MASSIVE", 50000))
FREQUENCIES = {"HIGH": ("1s", "1m", "5m", "15m", "30m"), "MEDIUM": ("1h", "4h", "12h"), "LOW": ("1d", "3d", "1w", "1M", "3M")}
#: Likely periods of each interval.
PERIODS = {
    "1s": (60, 3600), "15s": (4, 240), "30s": (2, 120), "1m": (60, 1440), "3m": (20, 480), "5m": (12, 288), "15m": (4, 96), "30m": (2, 48), "1h": (24, 168),
    "3h": (8, 56), "6h": (4, 28), "12h": (2, 14), "1d": (7, 30), "3d": (2, 10), "1w": (4, 52), "1M": (12,),
}
#: Least rows for which a series of an interval is decomposed.
DECOMPOSE_FROM = {"1s": 7200, "1m": 1440, "5m": 576, "15m": 384, "1h": 168, "1d": 60}


def length_class(n: Column) -> Column:
    out = F.lit(LENGTHS[0][0])
    for name, least in LENGTHS[1:]:
        out = F.when(n >= least, name).otherwise(out)
    return out


def frequency_class(code: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, codes in FREQUENCIES.items():
        out = F.when(code.isin(*codes), name).otherwise(out)
    return out


def likely_periods(code: Column) -> Column:
    pairs = [x for k, v in PERIODS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]
    return F.coalesce(F.create_map(*pairs)[code], F.array().cast("array<int>"))


def direct_method(n: Column, code: Column) -> Column:
    """Whether outliers are looked for without a decomposition: monthly series always, others under a length."""
    least = F.greatest(F.lit(60), F.floor(n * 0.2))
    for k, v in DECOMPOSE_FROM.items():
        least = F.when(code == k, F.lit(v)).otherwise(least)
    return code.isin("1M", "3M") | (n < least)


def is_stale(calculated_at: Column, as_of: Column, max_age_days: Column, force: Column) -> Column:
    return force | (F.datediff(as_of, calculated_at) > max_age_days)


def thinned(values: Column, most: int = 200, head: int = 50) -> Column:
    """At most ``most`` elements: the first ``head`` and evenly spaced ones of the rest."""
    n = F.size(values)
    last = most - head - 1
    step = (n - 1 - head).cast("double") / last
    spaced = F.transform(F.sequence(F.lit(0), F.lit(last)), lambda i: F.get(values, F.when(i == last, n - 1).otherwise(F.floor(head + i * step)).cast("int")))
    return F.when(n <= most, values).otherwise(F.concat(F.slice(values, 1, head), spaced))


def table_parts(name: Column) -> Column:
    """``currency, interval, stage`` of a table's name."""
    part = lambda k: F.regexp_extract(name, r"^(.+)_([^_]+)_(raw|transformed)$", k)
    return F.struct(part(1).alias("currency"), part(2).alias("interval_code"), part(3).alias("stage"))


def _nth(year: int, month: int, weekday: int, n: int) -> date:
    """The n-th given weekday of a month; from its end where n is negative."""
    if n > 0:
        first = date(year, month, 1)
        return first + timedelta((weekday - first.weekday()) % 7 + 7 * (n - 1))
    last = date(year + month // 12, month % 12 + 1, 1) - timedelta(1)
    return last - timedelta((last.weekday() - weekday) % 7)


def us_holidays(year: int) -> dict[date, str]:
    """Federal holidays by rule, with the days on which those of a weekend are observed."""
    fixed = {(1, 1): "New Year", (7, 4): "Independence Day", (11, 11): "Veterans Day", (12, 25): "Christmas"} | ({(6, 19): "Juneteenth"} if year >= 2021 else {})
    out = {date(year, m, d): name for (m, d), name in fixed.items()}
    for d, name in list(out.items()):
        shift = {5: -1, 6: 1}.get(d.weekday())
        if shift:
            out[d + timedelta(shift)] = f"{name} (observed)"
    moving = {"Martin Luther King Day": (1, 0, 3), "Washington's Birthday": (2, 0, 3), "Memorial Day": (5, 0, -1), "Labor Day": (9, 0, 1), "Columbus Day": (10, 0, 2), "Thanksgiving": (11, 3, 4)}
    out |= {_nth(year, *rule): name for name, rule in moving.items()}
    if date(year + 1, 1, 1).weekday() == 5:
        out[date(year, 12, 31)] = "New Year (observed)"
    return {d: n for d, n in out.items() if d.year == year}


def holidays(spark: SparkSession, first: int, last: int) -> DataFrame:
    """``(date, name)`` of the years given; a few hundred rows at most for a century's tenth."""
    rows = [(d, n) for y in range(first, last + 1) for d, n in sorted(us_holidays(y).items())]
    return spark.createDataFrame(rows, "date date, name string")
