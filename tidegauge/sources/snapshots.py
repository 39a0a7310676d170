"""Tables and their copies: create, drop, swap, back up with rotation, profile."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def retry(times: int = 5, backoff: float = 0.5, wait: Callable[[float], None] = time.sleep):
    """Try driver-side input and output again, waiting longer each time; the last error is raised."""

    def wrap(fn):
        @wraps(fn)
        def call(*a, **k):
            for attempt in range(times):
                try:
                    return fn(*a, **k)
                except OSError:
                    if attempt == times - 1:
                        raise
                    wait(backoff + 0.5 * attempt)

        return call

    return wrap


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def recover(spark: SparkSession, path: str) -> bool:
    """Put the old table back where a swap was cut short; whether that was needed."""
    fs, p = _fs(spark, path)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}__old")
    return bool(not fs.exists(p) and fs.exists(old) and fs.rename(old, p))


def drop(spark: SparkSession, path: str, suffix: str = "") -> bool:
    """Delete a table, or its variant with a suffix; whether there was one."""
    fs, p = _fs(spark, f"{path}{suffix}")
    return bool(fs.delete(p, True))


def create_if_absent(spark: SparkSession, path: str, schema: str) -> bool:
    """An empty table of a schema where there is none; whether it was made."""
    if exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.parquet(path)
    return True


def list_tables(spark: SparkSession, base: str, like: str = "%") -> list[str]:
    """Names of the tables under a folder that match a LIKE pattern, without those of swaps and the engine's own."""
    fs, p = _fs(spark, base)
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []
    names = [n for n in names if not n.startswith(("_", ".")) and not n.endswith(("__new", "__old"))]
    if not names:
        return []
    return [r.name for r in spark.createDataFrame([(n,) for n in names], "name string").where(F.col("name").like(like)).orderBy("name").collect()]


#: Databases that no listing shows.
SYSTEM_DATABASES = ("system", "information_schema", "INFORMATION_SCHEMA")


def list_databases(spark: SparkSession, like: str = "%") -> list[str]:
    names = spark.createDataFrame([(d.name,) for d in spark.catalog.listDatabases()], "name string")
    return [r.name for r in names.where(F.col("name").like(like) & ~F.col("name").isin(*SYSTEM_DATABASES)).orderBy("name").collect()]


def asset_config(spark: SparkSession, path: str) -> DataFrame:
    """``(symbol, interval)`` of an asset file: a JSON object of lists of intervals by symbol."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,array<string>>").alias("m"))
    return raw.select(F.explode("m").alias("symbol", "intervals")).select("symbol", F.explode("intervals").alias("interval"))


def swap(df: DataFrame, path: str) -> None:
    """Write beside a table, then take its place by renaming; the old one goes last.

    A driver lost between the two renames leaves no table under its name, but the old one whole: ``recover`` brings it back.
    """
    spark = df.sparkSession
    recover(spark, path)
    df.write.mode("overwrite").parquet(f"{path}__new")
    fs, p = _fs(spark, path)
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(f"{path}{x}") for x in ("__new", "__old"))
    fs.delete(old, True)
    if fs.exists(p):
        fs.rename(p, old)
    fs.rename(new, p)
    fs.delete(old, True)


def backup(spark: SparkSession, tables: dict[str, str], base: str, keep: int = 5) -> str:
    """Copy tables into a new generation with a manifest of schemas and counts; only the last ``keep`` stay."""
    fs, p = _fs(spark, base)
    held = sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []
    held = [h for h in held if h.startswith("gen-")]
    now = f"gen-{(int(held[-1][4:]) if held else 0) + 1:06d}"
    rows = []
    for name, path in tables.items():
        df = spark.read.parquet(path)
        df.write.parquet(f"{base}/{now}/{name}")
        rows.append((name, df.count(), df.schema.json()))
    spark.createDataFrame(rows, "name string, n_rows long, schema string").coalesce(1).write.json(f"{base}/{now}/_manifest")
    for h in held[: max(0, len(held) + 1 - keep)]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{h}"), True)
    return now


def restore(spark: SparkSession, base: str, target: dict[str, str], generation: str | None = None) -> list[str]:
    """Bring back tables that are absent; returns which."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    generation = generation or max(s.getPath().getName() for s in fs.listStatus(p) if s.getPath().getName().startswith("gen-"))
    done = []
    for r in spark.read.json(f"{base}/{generation}/_manifest").collect():
        if r.name in target and not exists(spark, target[r.name]):
            df = spark.read.schema(T.StructType.fromJson(json.loads(r.schema))).parquet(f"{base}/{generation}/{r.name}")
            df.write.parquet(target[r.name])
            done.append(r.name)
    return done


def profile(df: DataFrame) -> DataFrame:
    """``column, type, n_rows, n_null`` in one pass."""
    s = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"_{k}") for k, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col("_n").alias("n_rows"), F.col(f"_{k}").alias("n_null")) for k, (c, t) in enumerate(df.dtypes)])
    return s.select(F.explode(rows).alias("r")).select("r.*")
