"""Scans of series tables, landing-zone rows, tolerant casts, snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Sessions of an asset type as time zone, opening and closing.
SESSIONS = {"stock": ("America/New_York", "09:30", "16:00"), "forex": ("UTC", "00:00", "24:00")}
KNOWN_LACKS = "month_where_lacks timestamp_ntz, ts_id string, rows_amount long, data_created string"


def full_scan(df: DataFrame) -> DataFrame:
    return df.orderBy("ts_id", "open_time")


def time_range(df: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """From start to before end."""
    t = F.col("open_time")
    return df.where((t >= F.lit(start).cast("timestamp_ntz")) & (t < F.lit(end).cast("timestamp_ntz")))


def one_series(df: DataFrame, currency: str, interval: str) -> DataFrame:
    return df.where(F.col("ts_id") == f"crypto_{currency}_{interval}").orderBy("open_time")


def catalogue(df: DataFrame) -> DataFrame:
    """The series of a table with the parts of their ids."""
    parts = F.split("ts_id", "_")
    return df.select("ts_id").distinct().select("ts_id", parts[0].alias("instrument_type"), parts[1].alias("currency"), parts[2].alias("interval_code"), F.lit(True).alias("is_active"))


def to_number(c: Column) -> Column:
    """Null where it isn't a number."""
    return c.try_cast("double")


def to_time(c: Column) -> Column:
    return c.try_cast("timestamp_ntz")


def kline_rows(raw: DataFrame, ts_id: str, source: str) -> DataFrame:
    """Landing-zone rows with epoch milliseconds and decimal strings as candle columns."""
    return raw.select(
        F.lit(ts_id).alias("ts_id"), F.timestamp_millis("open_ms").cast("timestamp_ntz").alias("open_time"), to_number(F.col("open")).alias("open"),
        F.col("trades").cast("string").alias("number_of_trades"), F.lit(source).alias("source"),
    )


def landing_json(spark: SparkSession, path: str, ts_id: str, source: str) -> DataFrame:
    """Candles from files of one JSON array of twelve fields on each line."""
    a = F.from_json("value", "array<string>")
    raw = spark.read.text(path).select(a.alias("a")).where("a IS NOT NULL")
    names = ("open", "high", "low", "close", "volume")
    return raw.select(
        F.lit(ts_id).alias("ts_id"), F.timestamp_millis(F.col("a")[0].cast("long")).cast("timestamp_ntz").alias("open_time"),
        *[to_number(F.col("a")[k]).alias(n) for k, n in enumerate(names, 1)], F.timestamp_millis(F.col("a")[6].cast("long")).cast("timestamp_ntz").alias("close_time"),
        to_number(F.col("a")[7]).alias("quote_asset_volume"), F.col("a")[8].cast("long").alias("number_of_trades"),
        to_number(F.col("a")[9]).alias("taker_buy_base_asset_volume"), to_number(F.col("a")[10]).alias("taker_buy_quote_asset_volume"), F.lit(source).alias("source"),
    )


def market_open(t: Column, asset: str) -> Column:
    """Whether a UTC time is within an asset's session; what trades always is always open."""
    if asset not in SESSIONS:
        return F.lit(True)
    zone, start, end = SESSIONS[asset]
    local = F.from_utc_timestamp(t.cast("timestamp"), zone)
    clock = F.date_format(local, "HH:mm")
    return (clock >= start) & (clock < end) & (F.weekday(local) < 5)


def known_lacks(spark: SparkSession, path: str) -> DataFrame:
    """The CSV of known lacks; empty where there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], KNOWN_LACKS)
    return spark.read.csv(path, schema=KNOWN_LACKS, header=True)


def write_candles(df: DataFrame, path: str, mode: str = "append") -> None:
    """Parquet by series and month, ordered by time within files; only the partitions at hand are overwritten."""
    out = df.withColumn("ym", F.date_format("open_time", "yyyyMM"))
    out = out.repartition("ts_id", "ym").sortWithinPartitions("ts_id", "ym", "open_time")
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("ts_id", "ym").parquet(path)


def read_candles(spark: SparkSession, path: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """With bounds, months outside them aren't read."""
    df = spark.read.option("basePath", path).parquet(path)
    ym = F.col("ym").cast("string")
    if start:
        df = df.where((ym >= f"{start:%Y%m}") & (F.col("open_time") >= F.lit(start).cast("timestamp_ntz")))
    if end:
        df = df.where((ym <= f"{end:%Y%m}") & (F.col("open_time") < F.lit(end).cast("timestamp_ntz")))
    return df.drop("ym")
