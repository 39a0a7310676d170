"""Base tables and the candle tables derived from them.

Every reader takes the directory as given and leaves the path to Spark, so that any store Spark reads will do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def candles(ticks: DataFrame, *, unit: str, series: F.Column, ts: str, value: str, tie: str) -> DataFrame:
    """OHLCV rows per series and ``unit`` bucket (hour or day).

    Open and close are the values at the least and greatest ``(ts, tie)``; volume is the sum of absolute values. All
    aggregates combine before the one shuffle on ``(ts_id, open_time)``.
    """
    order = F.struct(F.col(ts), F.col(tie))
    return (
        ticks.groupBy(series.alias("ts_id"), F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz").alias("open_time"))
        .agg(
            F.min_by(value, order).alias("open"),
            F.max(value).alias("high"),
            F.min(value).alias("low"),
            F.max_by(value, order).alias("close"),
            F.sum(F.abs(F.col(value))).alias("volume"),
            F.count(F.lit(1)).alias("number_of_trades"),
        )
    )


def candles_evt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly candles of ``events``, one series per event type."""
    ticks = table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    series = F.concat(F.lit("crypto_"), F.col("event_type"), F.lit("_1h"))
    return candles(ticks, unit="hour", series=series, ts="ts", value="value", tie="event_id")


def candles_ord(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily candles of ``orders``, one series per priority."""
    ticks = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    series = F.concat(F.lit("crypto_"), F.lower("o_orderpriority"), F.lit("_1d"))
    return candles(ticks, unit="day", series=series, ts="o_orderdate", value="o_totalprice", tie="o_orderkey")


#: The same candles for DuckDB.
CANDLES_EVT_SQL = """candles_evt as (
  select 'crypto_'||event_type||'_1h' ts_id, cast(date_trunc('hour', ts) as timestamp) open_time,
         arg_min(value, (ts, event_id)) open, max(value) high, min(value) low, arg_max(value, (ts, event_id)) "close",
         sum(abs(value)) volume, cast(count(*) as bigint) number_of_trades
  from events group by 1, 2)"""
CANDLES_ORD_SQL = """candles_ord as (
  select 'crypto_'||lower(o_orderpriority)||'_1d' ts_id, cast(date_trunc('day', o_orderdate) as timestamp) open_time,
         arg_min(o_totalprice, (o_orderdate, o_orderkey)) open, max(o_totalprice) high, min(o_totalprice) low,
         arg_max(o_totalprice, (o_orderdate, o_orderkey)) "close", sum(abs(o_totalprice)) volume,
         cast(count(*) as bigint) number_of_trades
  from orders group by 1, 2)"""
