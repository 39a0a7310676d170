"""Streams of ticks: candles by tumbling window, rolling sums, sessions, deduplication, idempotent upserts.

The same operators run on a static table and give the same rows there, which the tests hold.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidegauge.operators.calendar import replace_range


def ticks(events: DataFrame, late: str | None = "1 hour") -> DataFrame:
    """``ts_id, ts, event_id, value`` with a watermark (``ts`` becomes a plain timestamp, as watermarks need one)."""
    out = events.select(F.concat(F.lit("crypto_"), "event_type", F.lit("_1h")).alias("ts_id"), F.col("ts").cast("timestamp").alias("ts"), "event_id", "value")
    return out.withWatermark("ts", late) if late else out


def tumbling_candles(t: DataFrame, width: str = "1 hour") -> DataFrame:
    order = F.struct("ts", "event_id")
    c = t.groupBy("ts_id", F.window("ts", width).alias("w")).agg(
        F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"),
        F.sum(F.abs("value")).alias("volume"), F.count(F.lit(1)).alias("number_of_trades"),
    )
    return c.select("ts_id", F.col("w.start").cast("timestamp_ntz").alias("open_time"), "open", "high", "low", "close", "volume", "number_of_trades")


def sliding_volume(t: DataFrame, width: str = "24 hours", step: str = "1 hour") -> DataFrame:
    c = t.groupBy("ts_id", F.window("ts", width, step).alias("w")).agg(F.sum(F.abs("value")).alias("volume"))
    return c.select("ts_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "volume")


def sessions(t: DataFrame, gap: str = "2 hours") -> DataFrame:
    c = t.groupBy("ts_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return c.select("ts_id", F.col("w.start").cast("timestamp_ntz").alias("start"), F.col("w.end").cast("timestamp_ntz").alias("stop"), "n")


def deduplicated(t: DataFrame) -> DataFrame:
    return t.dropDuplicatesWithinWatermark(["ts_id", "event_id"]) if t.isStreaming else t.dropDuplicates(["ts_id", "event_id"])


def running_properties(t: DataFrame) -> DataFrame:
    """Count, sum and last time of each series kept as state, one row for each batch that touches it."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for f in frames:
            n, total = n + len(f), total + float(f["value"].sum())
        state.update((n, total))
        yield pd.DataFrame({"ts_id": [key[0]], "n": [n], "total": [total]})

    return t.groupBy("ts_id").applyInPandasWithState(update, "ts_id string, n long, total double", "n long, total double", "update", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> None:
    """Everything available into a memory table, then stop."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def upsert_to(path: str):
    """A foreachBatch sink: a batch's rows replace the stored ones in their span, so a repeated batch changes nothing.

    Only the months at hand are read and written again.
    """

    def write(batch: DataFrame, _: int) -> None:
        spark, batch = batch.sparkSession, batch.persist()
        try:
            if batch.isEmpty():
                return
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            months = batch.select("ts_id", F.date_format("open_time", "yyyyMM").alias("ym")).distinct()
            new = batch
            if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
                stored = spark.read.parquet(path).withColumn("ym", F.col("ym").cast("string")).join(months, ["ts_id", "ym"], "left_semi")
                new = replace_range(stored.select(*batch.columns), batch).checkpoint()
            out = new.withColumn("ym", F.date_format("open_time", "yyyyMM"))
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ts_id", "ym").parquet(path)
        finally:
            batch.unpersist()

    return write
