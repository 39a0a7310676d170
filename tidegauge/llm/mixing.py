"""Mixing sources to target weights, in DataFrame operations only.

Tokens (words) are counted per source; each source's target follows from its weight; a source's repetition rate is
target / size. A document is then emitted floor(rate) times, plus once more if a hash-seeded Bernoulli draw of its id with
probability rate - floor(rate) says so. Each source has eight hash seeds, all taken from one SHA-256, and uses the one whose
total comes nearest its target (of equally near ones the first). That is a deviation from one plain draw: given the seed
the copies are no longer independent; it is there because a source of few documents would miss its target otherwise.

The targets' windows run over one row for each source, in one task: that holds for millions of sources, not for a source
to each document.

Defined cases: null text has size 0; texts of any length are counted whole; null source is a source of its own, ordered
last; a source of no words has target and rate 0; a null id draws like the empty string; rows with equal ids draw alike;
other columns, whatever their names, pass on unread; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import Saved, unused

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
SEEDS = 8


def word_count(text: str = "text") -> Column:
    """Words of a text without an array of them: each word with the space behind it becomes one letter."""
    space = r" \t\n\x0B\f\r"
    tail = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), rf"^[{space}]++", "")
    return F.length(F.regexp_replace(tail, rf"[^{space}]++[{space}]*+", "w")).cast("long")


def _draws(doc_id: str) -> list[Column]:
    digest = F.sha2(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), 256)
    return [F.conv(F.substring(digest, 1 + 8 * s, 8), 16, 10).cast("double") / F.lit(4294967296.0) for s in range(SEEDS)]


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)``: weights by code-point order, water-filled up to the cap.

    With sources ordered by cap / weight, those before the first source whose cap isn't reached get their cap, and the
    others the rest by weight. The windows run over one row for each source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    kth = F.array(*map(F.lit, weights))
    per = per.withColumn("w", F.element_at(kth, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    per = per.withColumn("cap", F.col("source_size") * F.lit(float(cap))).withColumn("ratio", F.col("cap") / F.col("w"))
    per = per.withColumn("all_size", F.sum("source_size").over(everything)).withColumn("all_w", F.sum("w").over(everything))
    per = per.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), zero.cast("double")))
    per = per.withColumn("w_before", F.coalesce(F.sum("w").over(before), zero.cast("long")))
    level = (F.col("all_size") * F.lit(float(share)) - F.col("cap_before")) / (F.col("all_w") - F.col("w_before"))
    per = per.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", F.col("source").isNull(), "source", "level"))
    per = per.withColumn("level", F.min(fits).over(everything)["level"])
    whole = F.coalesce(F.col("level") * F.col("w"), F.col("cap"))
    return per.select("source", "source_size", F.least(F.col("cap"), whole).alias("target"))


def plan(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``(source, source_size, target, floor, fraction, seed)`` from ``(doc_id, source, size)``."""
    goal = Saved(targets(sizes, weights, share, cap), "targets").df
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap)))).otherwise(0.0)
    goal = goal.withColumn("floor", F.floor(rate)).withColumn("fraction", rate - F.floor(rate))
    each = sizes.alias("d").join(goal.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source")))
    extra = [F.sum(F.when(u < F.col("fraction"), F.col("size")).otherwise(0)).alias(f"x{s}") for s, u in enumerate(_draws("doc_id"))]
    sums = each.groupBy("g.source", "source_size", "target", "floor", "fraction").agg(*extra)
    off = [F.struct(F.abs(F.col("floor") * F.col("source_size") + F.col(f"x{s}") - F.col("target")).alias("off"), F.lit(s).alias("seed")) for s in range(SEEDS)]
    return sums.select("source", "source_size", "target", "floor", "fraction", F.least(*off)["seed"].alias("seed"))


def copies(doc_id: str = "d.doc_id", plan_: str = "p") -> Column:
    """How often a row ``d`` joined with its source's plan ``p`` is emitted."""
    floor, fraction, seed = (F.col(f"{plan_}.{c}") for c in ("floor", "fraction", "seed"))
    draw = F.element_at(F.array(*_draws(doc_id)), (seed + 1).cast("int"))
    return (floor + F.when(draw < fraction, 1).otherwise(0)).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count().alias("size"))


def decide(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies)`` for every document."""
    sizes = Saved(measured(docs), "sizes").df
    p = Saved(plan(sizes, **options), "plan").df
    return sizes.alias("d").join(p.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))).select(
        "doc_id", "d.source", "size", "source_size", "target", copies().alias("copies")
    )


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: the rows of ``docs``, each as often as its source's plan says."""
    p = Saved(plan(Saved(measured(docs), "sizes").df, **options), "plan").df
    n, one = unused("_copies", docs), unused("_copy", docs)
    fields = [F.col(f"d.`{c}`") for c in docs.columns]
    joined = docs.alias("d").join(p.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    joined = joined.select(*fields, copies().cast("int").alias(n)).where(F.col(n) > 0)
    return joined.select("*", F.explode(F.array_repeat(F.lit(0), F.col(n))).alias(one)).drop(n, one)


ORACLE = """with sizes as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as bigint) size,
         sha256(coalesce(cast(doc_id as varchar), '')) h from documents),
per as (select source, cast(sum(size) as bigint) source_size from sizes group by source),
ranked as (select *, [5, 2, 1][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)] w, source_size * 2.0::double cap from per),
filled as (select *, cap / w ratio, sum(source_size) over () all_size, sum(w) over () all_w,
           coalesce(sum(cap) over (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0) cap_before,
           coalesce(sum(w) over (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0) w_before from ranked),
leveled as (select *, (all_size * 1.5::double - cap_before) / (all_w - w_before) lv from filled),
level as (select arg_min(lv, (ratio, source is null, source)) lv from leveled where lv <= ratio),
goal as (select source, source_size, least(cap, coalesce((select lv from level) * w, cap)) target from ranked),
rated as (select *, case when source_size > 0 then least(target / source_size, 2.0::double) else 0 end rate from goal),
drawn as (select doc_id, size, r.source, source_size, target, cast(floor(rate) as bigint) fl, rate - floor(rate) fr, s,
          cast(('0x' || substr(h, 1 + 8 * s, 8)) as bigint) / 4294967296.0::double < rate - floor(rate) more
          from sizes d join rated r on d.source is not distinct from r.source, (select unnest(range(8))::int s)),
best as (select source, arg_min(s, (off, s)) s from (
          select source, s, abs(any_value(fl) * any_value(source_size) + sum(case when more then size else 0 end) - any_value(target)) off
          from drawn group by source, s) group by source)
select doc_id, size, source_size, target, cast(size * (fl + case when more then 1 else 0 end) as bigint) taken
from drawn d join best b on d.s = b.s and d.source is not distinct from b.source"""
