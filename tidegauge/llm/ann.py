"""Approximate nearest neighbours by cross-polytope hashing.

A vector is scaled to unit length, padded to a power of two and turned by pseudo-rotations, each three rounds of random
signs and a fast Hadamard transform. Its hash is the nearest signed axis, the place and sign of its largest coordinate;
a table's bucket joins the hashes of K rotations. A query also probes the buckets of its next likely axes, best first.
Candidates that share a bucket with a probe are ranked by exact distance on the original vectors, in double precision.

K follows the number of rows, so that buckets stay small; tables and probes follow K and the number of rows (``settings``).

Vectors ship with their table entries, once for each table; bucket by bucket they meet the probes in groups of bounded
size. Small buckets share a group; one with many entries or many probes is dealt over several groups on both sides, so that
each part of its entries meets each part of its probes once. A group returns a query's nearest only, which loses nothing:
the nearest of all are among the nearest of each part. (Sending ids first and fetching the vectors of the candidates would
send more: a query has thousands of candidates, a vector 16 to 32 tables.)
Of equal vectors only the ``k`` + 1 with the least ids are entered, as no other can be among a query's k nearest.
Queries that found fewer than k are answered exhaustively, in blocks.

Defined cases: a vector that is null, empty, zero, or holds a null or non-finite component takes no part, neither do null
ids; so do vectors of another length than most; of rows with equal ids each is a candidate, other queries' too; with fewer
than k candidates all are returned; other columns, whatever their names, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import Saved

GROUP_ROWS = 8192
#: Distances computed at once.
PAIRS = 1 << 15
SEED = 20240229
_FOUND = "query_id long, vec_id long, score double"


def settings(n: int) -> dict[str, int]:
    """Rotations for each table, tables and probes for n vectors, which callers may override one by one.

    Buckets are as many as signed axes to the power of the rotations, so more rows need more rotations for buckets of a few
    rows; each setting gives the same result up to recall, which the README has for the sizes measured.
    """
    if n < 1 << 15:
        few = max(0, math.ceil(math.log2((1 << 13) / max(n, 64))))
        return {"rotations": 1, "tables": 16, "probes": 4 + 2 * few}
    if n < 1 << 22:
        return {"rotations": 2, "tables": 24, "probes": 64}
    return {"rotations": 3, "tables": 32, "probes": 512}


class Hash:
    def __init__(self, dim: int, rotations: int, tables: int):
        self.dim, self.size = dim, 1 << max(1, (dim - 1).bit_length())
        self.signs = np.random.default_rng(SEED).choice([-1.0, 1.0], (tables, rotations, 3, self.size))
        self.tables, self.rotations = tables, rotations

    def turned(self, x: np.ndarray, table: int, rotation: int) -> np.ndarray:
        """Butterflies run down the first axis, so that each step is one pass over contiguous rows."""
        y = np.zeros((self.size, len(x)))
        y[: self.dim] = x.T
        for signs in self.signs[table, rotation]:
            y *= signs[:, None]
            h = 1
            while h < self.size:
                z = y.reshape(-1, 2, h, y.shape[1])
                low = z[:, 0] - z[:, 1]
                z[:, 0] += z[:, 1]
                z[:, 1] = low
                h *= 2
        return y.T / self.size**1.5

    def buckets(self, x: np.ndarray, table: int) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for r in range(self.rotations):
            y = self.turned(x, table, r)
            k = np.abs(y).argmax(axis=1)
            out = out * 2 * self.size + k + self.size * (y[np.arange(len(y)), k] < 0)
        return out

    def probes(self, x: np.ndarray, table: int, n: int) -> np.ndarray:
        """The n likeliest buckets of each row, best first: the sum of the coordinates on the axes chosen is greatest."""
        score, bucket = np.zeros((len(x), 1)), np.zeros((len(x), 1), np.int64)
        for r in range(self.rotations):
            y = self.turned(x, table, r)
            both = np.concatenate([y, -y], axis=1)
            top = np.argsort(-both, axis=1, kind="stable")[:, :n]
            s = (score[:, :, None] + np.take_along_axis(both, top, axis=1)[:, None, :]).reshape(len(x), -1)
            b = (bucket[:, :, None] * 2 * self.size + top[:, None, :]).reshape(len(x), -1)
            best = np.argsort(-s, axis=1, kind="stable")[:, :n]
            score, bucket = np.take_along_axis(s, best, axis=1), np.take_along_axis(b, best, axis=1)
        return bucket


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64) if len(column) else np.zeros((0, dim))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _flat(b: pa.RecordBatch, dim: int):
    """Ids and vectors of a batch of rows, in blocks."""
    ids = b.column(0).to_numpy(zero_copy_only=False)
    x = _matrix(b.column(1), dim)
    return ids, x


def _hashed(batches, maker, dim: int):
    """The rows with their bucket in every table."""
    h = Hash(**maker)
    for b in batches:
        ids, x = _flat(b, dim)
        if len(ids):
            u = _unit(x)
            own = np.stack([h.buckets(u, t) for t in range(h.tables)], axis=1)
            at = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * h.tables)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(at, pa.array(own.ravel()))], names=["vec_id", "v", "buckets"])


def _probes(batches, maker, dim: int, n: int):
    h = Hash(**maker)
    for b in batches:
        ids, x = _flat(b, dim)
        if len(ids):
            u = _unit(x)
            for t in range(h.tables):
                p = h.probes(u, t, n)
                at = pa.array(np.repeat(np.arange(len(ids)), p.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(p.size, t)), pa.array(p.ravel()), b.column(0).take(at), b.column(1).take(at)], names=["t", "bucket", "query_id", "q"])


def _best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> list[np.ndarray]:
    """The k first of each query by score and id, each pair once."""
    order = np.lexsort((vec, score, query))
    q, v, s = query[order], vec[order], score[order]
    once = np.r_[True, (q[1:] != q[:-1]) | (v[1:] != v[:-1]) | (s[1:] != s[:-1])][: len(q)]
    q, v, s = q[once], v[once], s[once]
    start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]][: len(q)])
    keep = np.arange(len(q)) - np.repeat(start, np.diff(np.r_[start, len(q)])) < k
    return [q[keep], v[keep], s[keep]]


def _meet(k: int, dim: int, by_bucket: bool):
    """For one group: each query against the entries of the buckets that it probes (or all)."""

    def call(left, right):
        ids, qid = (t[c].combine_chunks().to_numpy(zero_copy_only=False) for t, c in ((left, "vec_id"), (right, "query_id")))
        x, q = (_matrix(t[c].combine_chunks(), dim) for t, c in ((left, "v"), (right, "q")))
        if by_bucket:
            key, probe = (t["t"].to_numpy() << 42 ^ t["bucket"].to_numpy() for t in (left, right))
            order = np.argsort(key, kind="stable")
            a, b = np.searchsorted(key[order], probe), np.searchsorted(key[order], probe, side="right")
        else:
            order, a, b = np.arange(len(ids)), np.zeros(len(qid), np.int64), np.full(len(qid), len(ids))
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        cuts = np.flatnonzero(np.diff(np.cumsum(b - a) // PAIRS, prepend=0)) + 1
        for at in np.split(np.arange(len(qid)), cuts):
            n = b[at] - a[at]
            j = np.repeat(at, n)
            e = order[np.repeat(a[at] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            e, j = e[ids[e] != qid[j]], j[ids[e] != qid[j]]
            if len(e):
                s = np.sqrt(((x[e] - q[j]) ** 2).sum(axis=1))
                found = _best(*(np.concatenate(y) for y in zip(found, (qid[j], ids[e], s), strict=True)), k)
        return pa.Table.from_arrays([pa.array(y) for y in found], names=["query_id", "vec_id", "score"])

    return call


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v)`` of the vectors that take part."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    v = F.col("embedding").cast(kind if kind == "array<float>" else "array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & v.isNotNull() & fine)


def search(vectors: DataFrame, is_query, k: int = 10, **options: int) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest found of each row for which ``is_query`` holds."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").first()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = sizes
    chosen = settings(n) | options
    maker = {"dim": dim, "rotations": chosen["rotations"], "tables": chosen["tables"]}
    kind = rows.schema["v"].dataType.simpleString()
    rows = Saved(rows.where(F.size("v") == dim).dropDuplicates(["vec_id", "v"]), "vectors").df
    first = Window.partitionBy("v").orderBy("vec_id")
    index = rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1).drop("r")
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")).dropDuplicates()
    hashed = Saved(index.mapInArrow(partial(_hashed, maker=maker, dim=dim), f"vec_id long, v {kind}, buckets array<long>"), "hashed").df
    entries = hashed.select("vec_id", "v", F.posexplode("buckets").alias("t", "bucket")).withColumn("t", F.col("t").cast("long"))
    probes = queries.mapInArrow(partial(_probes, maker=maker, dim=dim, n=chosen["probes"]), f"t long, bucket long, query_id long, q {kind}")
    groups = max(1, -(-n * maker["tables"] // GROUP_ROWS))
    half = GROUP_ROWS // 2
    many = lambda df, name: df.groupBy("t", "bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > half).select("t", "bucket", F.ceil(F.col("n") / half).cast("long").alias(name))
    large = many(entries, "parts")
    # a query probes a bucket once at most, so with few queries no bucket has many probes and they need no count
    few = queries.count() <= half
    large = large.withColumn("turns", F.lit(1).cast("long")) if few else large.join(many(probes, "turns"), ["t", "bucket"], "full").fillna(1, ["parts", "turns"])
    large = Saved(large, "large").df
    small = F.pmod(F.xxhash64("t", "bucket"), F.lit(groups))
    each = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(c, F.lit(1).cast("long")) - 1))
    own = lambda key, c: F.pmod(F.xxhash64(key), F.coalesce(F.col(c), F.lit(1).cast("long")))
    e = entries.join(large, ["t", "bucket"], "left").withColumn("part", own("vec_id", "parts")).withColumn("turn", each(F.col("turns")))
    p = probes.join(large, ["t", "bucket"], "left").withColumn("turn", own("query_id", "turns")).withColumn("part", each(F.col("parts")))
    group = F.when(F.col("parts").isNull(), small).otherwise(F.xxhash64("t", "bucket", "part", "turn")).alias("g")
    e, p = e.select(group, "t", "bucket", "vec_id", "v"), p.select(group, "t", "bucket", "query_id", "q")
    found = e.groupBy("g").cogroup(p.groupBy("g")).applyInArrow(_meet(k, dim, True), _FOUND)
    by_score = Window.partitionBy("query_id").orderBy("score", "vec_id")
    top = Saved(found.distinct().withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k), "nearest").df
    poor = queries.join(top.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k), "query_id", "left_anti")
    poor = Saved(poor, "poor").df
    n_poor = poor.count()
    if n_poor:
        blocks, parts = -(-n_poor // 1024), -(-n // GROUP_ROWS)
        left = index.withColumn("b", F.pmod(F.xxhash64("vec_id"), F.lit(parts))).withColumn("a", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        right = poor.withColumn("a", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")).withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
        rest = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(_meet(k, dim, False), _FOUND)
        rest = rest.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
        top = top.join(poor.select("query_id"), "query_id", "left_anti").unionByName(rest)
    return top.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
