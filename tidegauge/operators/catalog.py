"""Series catalogue: versions, staleness, schema comparison and registry, forecast folds, model choice."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Type names that count as one.
EQUIVALENT = ({"int", "bigint", "long", "integer"}, {"boolean", "tinyint", "byte"}, {"float", "double"})
PROPERTIES = "ts_id string, property_id string, property_group string, calculated_at timestamp_ntz, is_active boolean, values map<string,string>"


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def fresh_properties(df: DataFrame, as_of: datetime, max_age_days: DataFrame) -> DataFrame:
    """The latest active version of each group that isn't older than its group's age limit."""
    now = latest(df.where("is_active"), ["ts_id", "property_group"], F.desc("calculated_at"), F.desc("property_id"))
    age = F.datediff(F.lit(as_of), F.to_date("calculated_at"))
    return now.join(max_age_days, "property_group").where(age <= F.col("max_age")).drop("max_age")


def add_version(old: DataFrame, new: DataFrame) -> DataFrame:
    """Append-only save: rows of the same series and group stop being active."""
    hit = new.select("ts_id", "property_group", F.lit(True).alias("_hit")).distinct()
    kept = old.join(hit, ["ts_id", "property_group"], "left")
    kept = kept.withColumn("is_active", F.col("is_active") & F.col("_hit").isNull()).select(*old.columns)
    return kept.unionByName(new.select(*old.columns))


def types_equivalent(a: str, b: str) -> bool:
    a, b = a.lower(), b.lower()
    return a == b or any(a in s and b in s for s in EQUIVALENT)


def ddl(name: str, schema: T.StructType, partition: list[str] | None = None) -> str:
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL") for f in schema)
    tail = f" PARTITIONED BY ({', '.join(partition)})" if partition else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet{tail}"


@dataclass(frozen=True)
class Change:
    kind: str  # add, drop or modify
    table: str
    column: str
    before: str | None
    after: str | None

    def undo(self) -> Change:
        kind = {"add": "drop", "drop": "add", "modify": "modify"}[self.kind]
        return Change(kind, self.table, self.column, self.after, self.before)


def create_statement(table: str, schema: T.StructType, partitions: list[str] | None = None) -> str:
    """The statement that makes a table of a schema where there is none."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema)
    by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{by}"


def dump_changes(changes: list[Change]) -> str:
    """A migration as a file: its changes in JSON, one a line."""
    return "\n".join(json.dumps(asdict(c), sort_keys=True) for c in changes)


def load_changes(text: str) -> list[Change]:
    return [Change(**json.loads(x)) for x in text.splitlines() if x.strip()]


def compare(old: dict[str, T.StructType], new: dict[str, T.StructType]) -> list[Change]:
    """Column changes from one set of tables to another, by table and column."""
    cells = lambda s: {(t, f.name): f.dataType.simpleString() for t, x in s.items() for f in x}
    a, b = cells(old), cells(new)
    out = []
    for key in sorted(a.keys() | b.keys()):
        x, y = a.get(key), b.get(key)
        if x is None or y is None:
            out.append(Change("add" if x is None else "drop", *key, x, y))
        elif not types_equivalent(x, y):
            out.append(Change("modify", *key, x, y))
    return out


def apply(tables: dict[str, T.StructType], changes: list[Change]) -> dict[str, T.StructType]:
    now = {t: {f.name: f.dataType.simpleString() for f in s} for t, s in tables.items()}
    for c in changes:
        columns = now.setdefault(c.table, {})
        if c.kind == "drop":
            if columns.pop(c.column, None) is None:
                raise ValueError(f"{c.table} has no column {c.column}")
        else:
            if (c.kind == "add") == (c.column in columns):
                raise ValueError(f"can't {c.kind} {c.table}.{c.column}")
            columns[c.column] = c.after
    return {t: T._parse_datatype_string(", ".join(f"`{k}` {v}" for k, v in s.items())) if s else T.StructType() for t, s in now.items()}


class Registry:
    """Versions of a schema as a Parquet table; migrations go up and down, or only say what they would do."""

    SCHEMA = "version long, table string, change string, column string, before string, after string, applied_at timestamp_ntz, undone boolean"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def rows(self) -> DataFrame:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], self.SCHEMA)
        return self.spark.read.schema(self.SCHEMA).parquet(self.path)

    def version(self) -> int:
        """The net version: applied migrations less those undone."""
        row = self.status().agg(F.max(F.when(F.col("active"), F.col("version")))).first()
        return row[0] or 0

    def status(self) -> DataFrame:
        per = self.rows().groupBy("version").agg(F.max_by("undone", "applied_at").alias("undone"), F.max("applied_at").alias("at"), F.count(F.lit(1)).alias("n_rows"))
        return per.select("version", (~F.col("undone")).alias("active"), "at", "n_rows").orderBy("version")

    def migrate(self, changes: list[Change], at: datetime, dry_run: bool = False) -> list[Change]:
        if not dry_run and changes:
            self._write(self.version() + 1, changes, at, False)
        return changes

    def rollback(self, at: datetime, dry_run: bool = False) -> list[Change]:
        """The last migration's changes undone, in reverse."""
        v = self.version()
        rows = self.rows().where((F.col("version") == v) & ~F.col("undone")).distinct().collect()
        latest_at = max((r.applied_at for r in rows), default=None)
        undo = [Change(r.change, r.table, r.column, r.before, r.after).undo() for r in rows if r.applied_at == latest_at][::-1]
        if not dry_run and undo:
            self._write(v, undo, at, True)
        return undo

    def _write(self, version: int, changes: list[Change], at: datetime, undone: bool) -> None:
        rows = [(version, c.table, c.kind, c.column, c.before, c.after, at, undone) for c in changes]
        self.spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)


def folds(df: DataFrame, n_splits: int, kind: str = "expanding", size: int | None = None) -> DataFrame:
    """Rows with their fold and role: expanding, rolling (``size`` rows) or walk-forward; a row may be in many folds."""
    by_time = Window.partitionBy("ts_id").orderBy("open_time")
    df = df.withColumn("_i", F.row_number().over(by_time) - 1).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("ts_id")))
    test = F.floor(F.col("_n") / (n_splits + 1))
    df = df.withColumn("_t", test).withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(n_splits))))
    first = F.col("_n") - (n_splits - F.col("fold") + 1) * F.col("_t")
    width = F.lit(size) if size else F.col("_t")
    train = (F.col("_i") < first) & (F.lit(True) if kind == "expanding" else F.col("_i") >= first - width)
    role = F.when(train, "train").when((F.col("_i") >= first) & (F.col("_i") < first + F.col("_t")), "test")
    return df.withColumn("role", role).where("role IS NOT NULL").drop("_i", "_n", "_t")


def best_model(models: DataFrame, score: str, tie: str) -> DataFrame:
    return models.groupBy("ts_id").agg(F.max_by(tie, F.struct(score, tie)).alias(tie), F.max(score).alias(score))


def ensemble(df: DataFrame, predictions: list[str]) -> DataFrame:
    return df.withColumn("ensemble", sum(F.col(p) for p in predictions) / len(predictions))
