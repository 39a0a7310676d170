"""Joins of series: alignment, fixed row windows around events, as-of and range joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def align(df: DataFrame, reference: str, value: str) -> DataFrame:
    """Every other series beside the reference series, at times that both have."""
    ref = df.where(F.col("ts_id") == reference).select("open_time", F.col(value).alias("reference"))
    return df.where(F.col("ts_id") != reference).select("ts_id", "open_time", F.col(value).alias("target")).join(ref, "open_time").select("ts_id", "open_time", "target", "reference")


def row_window(df: DataFrame, is_event: Column, value: str, k: int) -> DataFrame:
    """Values of the k rows before and after each event row, by offset: one window of leads and lags, no join."""
    w = Window.partitionBy("ts_id").orderBy("open_time")
    near = [F.struct(F.lit(o).alias("offset"), F.lead(value, o).over(w).alias("value"), F.lead("open_time", o).over(w).alias("t")) for o in range(-k, k + 1)]
    out = df.withColumn("_near", F.array(*near)).where(is_event)
    out = out.select("ts_id", F.col("open_time").alias("event_time"), F.explode("_near").alias("n")).where("n.t IS NOT NULL")
    return out.select("ts_id", "event_time", "n.offset", "n.value")


def as_of(left: DataFrame, right: DataFrame, value: str) -> DataFrame:
    """Each left row with the right side's last value at or before its time: both sides in one window, no range join."""
    extra = [c for c in left.columns if c not in ("ts_id", "open_time")]
    right = right.select("ts_id", "open_time", F.struct(F.col(value)).alias("_v"), *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in extra], F.lit(0).alias("_side"))
    both = left.select("ts_id", "open_time", F.lit(None).cast(right.schema["_v"].dataType).alias("_v"), *extra, F.lit(1).alias("_side")).unionByName(right)
    w = Window.partitionBy("ts_id").orderBy("open_time", "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_v", F.last("_v", ignorenulls=True).over(w)).where("_side = 1")
    return both.select(*left.columns, F.col(f"_v.{value}").alias(value))


def range_join(spans: DataFrame, points: DataFrame, start: str, end: str, at: str, bucket_seconds: int) -> DataFrame:
    """Points within spans, ends included, as an equi-join on time buckets."""
    bucket = lambda c: F.floor(F.unix_timestamp(F.col(c).cast("timestamp")) / bucket_seconds)
    s = spans.withColumn("_b", F.explode(F.sequence(bucket(start), bucket(end))))
    p = points.withColumn("_b", bucket(at))
    return s.join(p, "_b").where(F.col(at).between(F.col(start), F.col(end))).drop("_b")
