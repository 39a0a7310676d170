"""License statements in documents, in DataFrame operations only.

Texts and templates become words (lower case, letters and digits) and five-word shingles. A template of s shingles belongs
to the class L, the least power of two not under s; for each class a document has windows of 1.5 L shingles, one every
L / 2, so every run of L shingles lies in a window whole. A window's MinHash has ``BANDS`` bands of one row. A window that
holds 0.8 of a template has a Jaccard similarity of at least 0.25 with it (0.33 if it holds all), so some band agrees with
probability 0.9968 (0.9997) or more. Windows that agree with a template in a band are verified by the exact share of its
shingles in the window. Windows without any template shingle can't match and have no MinHash computed; that test is exact
and loses nothing, but it also means that the bands only choose among windows that hold some part of a template.

Templates of under five words are one shingle each of all their words and are not supported here: every template has five.

Defined cases: null texts match nothing; null ids are kept; texts of any length are scanned whole; rows with equal ids are
scanned each by its own text and give one result for the id; of equally good windows the first counts; an empty table gives
an empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH = 5
SHARE = 0.8
BANDS = 20
_BITS = 20

#: Public licence statements and notices.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "LGPL-2.1-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def with_shingles(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the hashes of the five-word shingles of a text column, in order.

    The lambda sees its own element only: a reference to the array of words in it would be evaluated for every element
    wherever the optimizer moves the expression.
    """
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]++", " "))
    rows = rows.withColumn("_words", F.split(plain, " ", -1))
    n = F.greatest(F.size("_words") - (WIDTH - 1), F.lit(0))
    five = F.arrays_zip(*[F.slice("_words", k + 1, n).alias(f"w{k}") for k in range(WIDTH)])
    return rows.withColumn(name, F.transform(five, lambda x: F.xxhash64(*[x[f"w{k}"] for k in range(WIDTH)]))).drop("_words")


def _signature(hashes: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, k))))


def _windows(size: int) -> Column:
    """The windows of a class that hold one of the places in ``at``."""
    step, long = max(1, size // 2), max(1, math.floor(1.5 * size))

    def around(p: Column) -> Column:
        first = F.greatest(F.floor((p - long) / step).cast("int") + 1, F.lit(0))
        return F.sequence(first, F.floor(p / step).cast("int"))

    starts = F.array_distinct(F.flatten(F.transform("at", around)))
    return F.transform(starts, lambda j: F.struct(F.lit(size).alias("size"), (j * step).alias("start"), F.lit(long).alias("long")))


def templates(spark: SparkSession, texts: dict[str, str] = TEMPLATES) -> DataFrame:
    """``(license, t, size)``: a template's distinct shingles and its class."""
    rows = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(v).alias("text")) for k, v in texts.items()])
    t = spark.range(1).select(F.explode(rows).alias("x")).select("x.license", "x.text")
    t = with_shingles(t, "text", "hs").select("license", F.array_distinct("hs").alias("t"), F.size("hs").alias("s"))
    return t.select("license", "t", F.pow(F.lit(2), F.ceil(F.log2(F.col("s")))).cast("int").alias("size"))


def scan(docs: DataFrame, texts: dict[str, str] = TEMPLATES, share: float = SHARE) -> DataFrame:
    """``(doc_id, license, containment, position)``: the best window's share and its place in shingles, for each license."""
    spark = docs.sparkSession
    known = templates(spark, texts)
    rows = known.collect()
    short = [r.license for r in rows if not r.t]
    if short:
        raise ValueError(f"templates of under {WIDTH} words: {short}")
    each = sorted({h for r in rows for h in r.t})
    bits = [0] * (1 << (_BITS - 6))
    for h in each:
        bits[(h >> 6) & ((1 << (_BITS - 6)) - 1)] |= 1 << (h & 63)
    bitmap = F.lit([b - (1 << 64) if b >> 63 else b for b in bits])
    all_shingles = F.lit(each)
    maybe = lambda h: F.getbit(F.get(bitmap, F.shiftright(h, 6).bitwiseAND(F.lit((1 << (_BITS - 6)) - 1)).cast("int")), h.bitwiseAND(F.lit(63)).cast("int")) == 1
    found = with_shingles(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "text", "hs").drop("text")
    place = F.transform("hs", lambda h, i: F.when(maybe(h) & F.array_contains(all_shingles, h), i))
    found = found.withColumn("at", F.array_compact(place))
    windows = [_windows(size) for size in sorted({r.size for r in rows})]
    found = found.select("doc_id", "hs", F.explode(F.concat(*windows)).alias("w"))
    found = found.select("doc_id", "w.size", "w.start", F.slice("hs", F.col("w.start") + 1, F.col("w.long")).alias("w")).where(F.size("w") > 0)
    found = found.select("doc_id", "size", "start", "w", F.posexplode(_signature(F.col("w"))).alias("band", "value"))
    bands = known.select("license", "size", "t", F.posexplode(_signature(F.col("t"))).alias("band", "value"))
    met = found.join(F.broadcast(bands), ["size", "band", "value"])
    exact = (F.size(F.array_intersect("t", "w")) / F.size("t")).alias("containment")
    best = met.select("doc_id", "license", exact, "start").where(F.col("containment") >= share)
    order = F.struct(-F.col("containment"), F.col("start"))
    return best.groupBy("doc_id", "license").agg(F.max("containment").alias("containment"), F.min_by("start", order).cast("long").alias("position"))


def _shingled_sql(text: str) -> str:
    return f"string_split(trim(regexp_replace(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"


def oracle(texts: dict[str, str] = TEMPLATES, share: float = SHARE) -> str:
    """Every window against every template by exact containment, without bands, as SQL."""
    values = ", ".join("('" + k + "', '" + v.replace("'", "''") + "')" for k, v in texts.items())
    each = f"list_transform(range(1, len(w) - {WIDTH - 2}), lambda i: array_to_string(w[i:i + {WIDTH - 1}], ' '))"
    return f"""with tw as (select license, {_shingled_sql('t')} w from (values {values}) v(license, t)),
ts as (select license, list_distinct({each}) t, cast(pow(2, ceil(log2(len(w) - {WIDTH - 1}))) as bigint) size from tw),
tt as (select license, size, len(t) n, unnest(t) sh from ts),
dw as (select row_number() over () rid, doc_id, {_shingled_sql('text')} w from documents),
ds as (select rid, doc_id, unnest({each}) sh, unnest(range(len(w) - {WIDTH - 1})) p from dw where len(w) >= {WIDTH}),
hits as (select rid, doc_id, license, n, sh, p, greatest(1, size // 2) step, greatest(1, cast(floor(1.5 * size) as bigint)) long from ds join tt using (sh)),
wins as (select rid, doc_id, license, n, sh, step, unnest(range(cast(greatest(0, floor((p - long)::double / step) + 1) as bigint), p // step + 1)) j from hits),
held as (select doc_id, license, j * step start, count(distinct sh)::double / any_value(n) containment from wins group by rid, doc_id, license, j * step)
select doc_id, license, max(containment) containment, cast(arg_min(start, (-containment, start)) as bigint) position from held where containment >= {share} group by 1, 2"""
