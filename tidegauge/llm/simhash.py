"""SimHash near-duplicate groups by covering locality-sensitive hashing.

A 64-bit SimHash is taken over word shingles. For a radius r, every bit position i gets a vector f(i) of r + 1 bits, none
zero; for each of the 2^(r+1) - 1 vectors v, a mask keeps the positions whose f(i) has an odd inner product with v. At
most r differing positions leave some v orthogonal to all their vectors, so every pair within the radius agrees under
some mask: no pair is missed. Each mask keeps about half of the bits, so few other pairs agree.

Equal fingerprints collapse before anything else. Buckets of two are compared in the JVM; larger ones in blocks of
bounded size, each giving at most one edge for each member. Where a bucket has several blocks, a second pass compares
blocks again, but only members that the first pass left in different components; so a dense group costs no square.

Defined cases: a null or blank text has fingerprint 0; texts under ``width`` words are one shingle; texts of any length are
hashed whole; of equal least ids in ``keep_one`` the one with the least fingerprint stays; rows with a null id
keep their row, but a null is never a component id unless the component has no other id; equal ids are separate rows; an
empty table gives an empty result; other columns, whatever their names, are not read (``keep_one`` passes them on).
"""

from __future__ import annotations

from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import Saved, bounded_batches, connected_components, unused

BITS = 64
BLOCK = 256


def fingerprint(data: bytes | None, width: int = 4) -> int:
    """The SimHash of a UTF-8 text, unsigned."""
    words = (data or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*(words[k:] for k in range(width)), strict=False)) if len(words) >= width else iter([b" ".join(words)])
    hashes, ones = map(partial(xxhash.xxh64_intdigest, seed=42), shingles), np.zeros(BITS, np.int64)
    for _ in range(0, n, 1 << 16):
        block = np.fromiter(islice(hashes, 1 << 16), np.uint64)
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches, width: int):
    for b in batches:
        got = np.fromiter((fingerprint(x, width) for x in b.column(1).to_pylist()), np.uint64, b.num_rows).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got)], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """``(doc_id, fp)``: the fingerprint as a signed long."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(partial(_fingerprints, width=width), "doc_id long, fp long")


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """The masks, unsigned. Bit i gets the vector 1 + i mod (2^(radius+1) - 1), so that all vectors are used evenly."""
    n = 2 ** (radius + 1) - 1
    return [sum(1 << i for i in range(bits) if ((1 + i % n) & v).bit_count() % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """``(member, root)`` pairs that connect what lies within the radius of each other, one for each member but roots."""
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
    free, out = np.ones(len(values), bool), []
    for root in range(len(values)):
        if free[root]:
            free[root], edge = False, np.array([root])
            while len(edge):
                edge = np.flatnonzero(near[edge].any(axis=0) & free)
                free[edge] = False
                out += [(int(values[i]), int(values[root])) for i in edge]
    return out


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    both = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["src", "dst"])


def _blocks(batches, radius: int):
    for b in batches:
        yield _edges([e for x in b.column(0) for e in forest(x.values.to_numpy().view(np.uint64), radius)])


def _between(batches, radius: int):
    """Links between two blocks whose members carry components: for each member of the second, its links into others."""
    for b in batches:
        out = []
        for fa, ra, fb, rb in zip(*(b.column(i) for i in range(4)), strict=True):
            fa, ra, fb, rb = (x.values.to_numpy() for x in (fa, ra, fb, rb))
            near = (np.bitwise_count(fa.view(np.uint64)[:, None] ^ fb.view(np.uint64)[None, :]) <= radius) & (ra[:, None] != rb[None, :])
            out += list({(int(ra[i]), int(rb[j])) for i, j in zip(*np.nonzero(near), strict=True)})
        both = np.array(out, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["src", "dst"])


def components(fps: DataFrame, radius: int) -> DataFrame:
    """``(node, root)`` over distinct fingerprints ``fps(fp)``; those without a link are left out."""
    masks = [_signed(m) for m in covering_masks(radius)]
    rows = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("m", "kept"))
    counted = Saved(
        rows.groupBy("m", "kept").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("src"), F.max("fp").alias("dst")).where("n > 1"),
        "buckets",
    )
    pairs = counted.df.where((F.col("n") == 2) & (F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= radius)).select("src", "dst")
    large = counted.df.where("n > 2").select("m", "kept", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks"))
    members = rows.join(large, ["m", "kept"]).withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    lists = members.groupBy("m", "kept", "block").agg(F.collect_list("fp").alias("fps")).select("fps")
    linked = lists.mapInArrow(partial(_blocks, radius=radius), "src long, dst long")
    edges = Saved(pairs.union(linked).distinct(), "links")
    found = connected_components(edges.df)
    if not counted.df.where(F.col("n") > BLOCK).isEmpty():
        found = Saved(found, "components").df
        more = _across(members.where("blocks > 1"), found, radius)
        found = connected_components(edges.df.union(more))
    return found


def _across(members: DataFrame, found: DataFrame, radius: int) -> DataFrame:
    """Links in buckets of several blocks, between members that are in different components so far.

    In each bucket, members outside its most frequent component are dealt into blocks and meet every block of the
    bucket. Where all members are in one component, nothing is compared.
    """
    at = members.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    per = at.groupBy("m", "kept", "root").agg(F.count(F.lit(1)).alias("n"))
    top = per.groupBy("m", "kept").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count(F.lit(1)).alias("roots")).where("roots > 1")
    at = at.join(top, ["m", "kept"])
    lists = lambda df: df.groupBy("m", "kept", "block").agg(F.collect_list("fp").alias("f"), F.collect_list("root").alias("r"))
    a = lists(at).toDF("m", "kept", "a", "fa", "ra")
    b = lists(at.where("root <> main")).toDF("m", "kept", "b", "fb", "rb")
    met = a.join(b, ["m", "kept"]).select("fa", "ra", "fb", "rb")
    return met.mapInArrow(partial(_between, radius=radius), "src long, dst long").distinct()


def near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4) -> DataFrame:
    """``(doc_id, fp, component_id, root)`` for every row; linked are fingerprints within ``radius`` differing bits.

    ``root`` is the least fingerprint of the component and names it even where it has no id.
    """
    each = Saved(fingerprints(docs, width), "fingerprints").df
    fps = Saved(each.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct").df
    roots = components(fps.select("fp"), radius)
    at = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = at.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = at.join(least, "root").select("fp", "component_id", "root")
    return each.join(classes, "fp").select("doc_id", "fp", "component_id", "root")


def _tagged(batches, text: int, width: int, name: str):
    for b in batches:
        got = np.fromiter((fingerprint((x.as_py() or "").encode(), width) for x in b.column(text)), np.uint64, b.num_rows).view(np.int64)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got)], names=[*b.schema.names, name])


def keep_one(docs: DataFrame, radius: int = 4, width: int = 4) -> DataFrame:
    """One row of each near-duplicate group, all columns: of its least id, then of its least fingerprint."""
    found = near_duplicates(docs, radius, width)
    fp = unused("_fp", docs)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("k")).select(F.col("k.doc_id").alias("id"), F.col("k.fp").alias("fp"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"{fp} long"])
    rows = docs.mapInArrow(partial(_tagged, text=docs.columns.index("text"), width=width, name=fp), schema)
    d, k = rows.alias("d"), first.alias("k")
    kept = d.join(k, F.col("d.doc_id").eqNullSafe(F.col("k.id")) & (F.col(f"d.{fp}") == F.col("k.fp")), "left_semi")
    return kept.dropDuplicates(["doc_id", fp]).drop(fp)
