"""Scratch tables, batch limits and connected components, shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows in an Arrow batch at most, so that a batch of long texts stays small in executors and Python workers.
ARROW_ROWS = 1000
#: What a task that saves a table reads at most of it, where partitions are small enough to share a task.
SAVE_BYTES = 16 << 20
_OWN_DIR: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(wanted: str, df: DataFrame) -> str:
    """A column name like ``wanted`` that ``df`` doesn't have, whatever the case of letters."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ``ARROW_ROWS`` if it is larger."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application under the session's ``spark.checkpoint.dir``, which all executors share.

    Only where that setting is absent and all runs in one process, as in local tests, a temporary folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        if not _OWN_DIR:
            _OWN_DIR.append(tempfile.mkdtemp(prefix="tidegauge-"))
        base = f"file://{_OWN_DIR[0]}"
    return f"{base.rstrip('/')}/tidegauge-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, kind: str) -> str:
    """An unused path in the shared folder; what is there goes when the driver ends."""
    path = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    atexit.register(_delete_quietly, spark, path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _delete_quietly(spark: SparkSession, path: str) -> None:
    try:
        delete(spark, path)
    except Exception:  # noqa: BLE001  the JVM may be gone at exit
        return


def read_bytes(df: DataFrame) -> int:
    """Bytes of the tables that a DataFrame reads, as far as Spark knows them before it runs; unknown ones count as endless."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))


class Saved:
    """A DataFrame written to the shared folder and read back: its lineage is cut, and lost executors cost nothing.

    With ``few_files`` a task writes small partitions one after the other into one file, so that many of them don't become
    as many small files: as long as a task's share of the tables read stays under ``SAVE_BYTES`` (or there is one task for
    each of four slots on every core), however large the input is.
    """

    def __init__(self, df: DataFrame, kind: str = "table", few_files: bool = True):
        self.spark = df.sparkSession
        self.path = new_path(self.spark, kind)
        if few_files:
            df = df.coalesce(min(1 << 30, max(4 * self.spark.sparkContext.defaultParallelism, -(-read_bytes(df) // SAVE_BYTES))))
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        delete(self.spark, self.path)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(src, dst)``; the root is the least node that can be reached.

    Alternating large-star and small-star rounds: the edges shrink to one star for each component in about
    log(diameter) rounds. Minima are combined before the shuffle and joins are plain equi-joins, which AQE splits
    where one node has very many edges. Each round is saved to the shared folder.
    """
    now = Saved(
        edges.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).where("u <> v").distinct(), "edges"
    )
    before = None
    while True:
        mark = now.df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if before == mark or not mark[0]:
            return now.df.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.df.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = mark
        both = now.df.union(now.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = large.join(least, "u").select(F.explode(pairs).alias("p")).select("p.u", "p.v").where("u <> v").distinct()
        then = Saved(small, "edges")
        now.drop()
        now = then
