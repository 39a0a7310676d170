"""Benchmark passages in documents, exact or with a few edits, by q-gram filtering and banded alignment.

Texts are compared in lower case with every white-space character as a space. An item of m characters may differ by at
most e = ``rate`` * m edits. An occurrence with e edits keeps at least m - Q + 1 - e * Q of the item's Q-grams, and all of
them lie on e + 1 neighbouring diagonals (position in the text less position in the item). Diagonals are dealt into
bands of 2 e + 1 that overlap by e, so one band holds them all; bands with too few shared Q-grams can't hold an
occurrence, and the rest are aligned within their band. Nothing that meets the budget is missed.

Items too short for the bound get the largest budget that it allows; items under Q characters must occur as they are.
The items go to the tasks in blocks of bounded size, one pass over the documents for each block.

Defined cases: null and blank items and null texts match nothing; a null document id is kept as null; rows with equal
ids are judged each by its own text; equal items are reported under each id; of equally good occurrences the first counts;
texts are searched whole, whatever their length; other columns, whatever their names, pass through or are not read; an empty
table on either side gives no match.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import Saved, bounded_batches

Q = 6
RATE = 0.1
BLOCK_CHARS = 4_000_000
TABLE_BITS = 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SPACE = re.compile(r"[^\S ]")


def normal(text: str | None) -> str:
    """Lower case, one space for each white-space character; of the same length as the text, so places agree."""
    text = text or ""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(d := c.lower()) != 1 else d for c in text)
    return _SPACE.sub(" ", low)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _grams(codes: np.ndarray) -> np.ndarray:
    """64-bit hashes of the Q-grams, at every position."""
    n = len(codes) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = codes[:n].astype(np.uint64)
    for k in range(1, Q):
        h *= _MULTIPLIER
        h += codes[k : n + k]
    h *= _MULTIPLIER
    h ^= h >> np.uint64(32)
    return h * _MULTIPLIER


class Items:
    """An index of one block of items."""

    def __init__(self, rows: list[tuple[int, str]], rate: float):
        self.ids, texts = [i for i, _ in rows], [normal(t) for _, t in rows]
        self.texts = texts
        m = np.array([len(t) for t in texts], np.int64)
        self.m = m
        self.edits = np.maximum(0, np.minimum((rate * m + 1e-9).astype(np.int64), (m - Q) // Q))
        self.least = np.maximum(1, m - Q + 1 - self.edits * Q)  # 1 for items under Q, which have no band
        self.step, self.overlap, self.per_step = (self.edits + 1).astype(np.int32), self.edits.astype(np.int32), 1.0 / (self.edits + 1)
        self.short = [k for k in range(len(rows)) if m[k] < Q]
        grams = [_grams(_codes(t)) for t in texts]
        item = np.repeat(np.arange(len(rows)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams] or [np.zeros(0, np.int64)])
        flat = np.concatenate(grams or [np.zeros(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        self.item, self.place, flat = item[order].astype(np.int32), place[order].astype(np.int32), flat[order]
        self.shifted = self.place - m[self.item].astype(np.int32)
        new = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.zeros(0, np.int64)
        self.gram, self.first = flat[new], np.r_[new, len(flat)]
        slot = (self.gram >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        self.slots = np.searchsorted(slot, np.arange((1 << TABLE_BITS) + 1)).astype(np.int32)
        self.filled = np.diff(self.slots) > 0

    def bands(self, codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """``(item, first diagonal, last diagonal)`` of the bands with enough shared Q-grams."""
        h = _grams(codes)
        slot = (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        at = np.flatnonzero(self.filled[slot])
        at_slot = slot[at]
        gram = self.slots[at_slot].astype(np.int64)
        last = self.slots[at_slot + 1] - 1
        value = h[at]
        while True:
            on = (self.gram[gram] != value) & (gram < last)
            if not on.any():
                break
            gram[on] += 1
        same = self.gram[gram] == value
        at, gram = at[same], gram[same]
        n = self.first[gram + 1] - self.first[gram]
        post = np.repeat((self.first[gram] - np.cumsum(n) + n).astype(np.int32), n) + np.arange(n.sum(), dtype=np.int32)
        item = self.item[post]
        diagonal = np.repeat(at.astype(np.int32), n) - self.shifted[post]
        band = ((diagonal + 0.5) * self.per_step[item]).astype(np.int32)
        again = (diagonal - band * self.step[item] < self.overlap[item]) & (band > 0)
        width = (len(codes) + self.m) // (self.edits + 1) + 2
        base = np.cumsum(np.r_[0, width])
        key = base[item] + band
        key = np.concatenate([key, key[again] - 1])
        if base[-1] <= max(1 << 16, 4 * len(key)):
            count = np.bincount(key, minlength=base[-1])
            keys = np.flatnonzero(count >= self.least.min())
            count = count[keys]
        else:
            keys, count = np.unique(key, return_counts=True)
        who = np.searchsorted(base, keys, side="right") - 1
        enough = count >= self.least[who]
        for k, x in zip(who[enough].tolist(), keys[enough].tolist(), strict=True):
            first = (x - int(base[k])) * (int(self.edits[k]) + 1) - int(self.m[k])
            yield k, first, first + 2 * int(self.edits[k])

    def matches(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """``(item, edits, start, end)``: each item's best occurrence, the first of equal ones."""
        low = normal(text)
        best: dict[int, tuple[int, int, int]] = {}
        for k in self.short:
            at = low.find(self.texts[k])
            if at >= 0:
                best[k] = (0, at, at + len(self.texts[k]))
        if len(low) >= Q and len(self.gram):
            codes = _codes(low)
            for k, first, last in self.bands(codes):
                if best.get(k, (1,))[0] == 0:
                    continue
                e, m = int(self.edits[k]), int(self.m[k])
                a, b = max(0, first - e), min(len(low), last + m + e)
                at = low.find(self.texts[k], a, b)
                got = (0, at, at + m) if at >= 0 else banded(codes, _codes(self.texts[k]), first, last, e)
                if got and (k not in best or got < best[k]):
                    best[k] = got
        return [(k, *v) for k, v in sorted(best.items())]


def banded(text: np.ndarray, item: np.ndarray, first: int, last: int, edits: int) -> tuple[int, int, int] | None:
    """``(edits, start, end)`` of the best occurrence of ``item`` that starts on the diagonals given, if within the budget.

    Row i of the table holds the least edits of the item's first i characters against text that ends on each diagonal of
    the band; the band is wider by the budget on both sides, since that is how far an occurrence can stray.
    """
    low, width, far = first - edits, last - first + 1 + 2 * edits, len(item) + len(text) + 1
    d = np.arange(width)
    start = low + d
    cost = np.where((start >= 0) & (start <= len(text)) & (d >= edits) & (d < width - edits), 0, far)
    for i, c in enumerate(item, 1):
        at = low + d + i - 1
        inside = (at >= 0) & (at < len(text))
        same = np.zeros(width, bool)
        same[inside] = text[at[inside]] == c
        step = np.where(inside, cost + ~same, far)
        from_item, origin = np.append(cost[1:] + 1, far), np.append(start[1:], 0)
        take = from_item < step
        step, start = np.where(take, from_item, step), np.where(take, origin, start)
        run = np.minimum.accumulate(step - d)
        better = run + d < step
        if better.any():
            lead = np.maximum.accumulate(np.where(step - d == run, d, 0))
            start, step = np.where(better, start[lead], start), np.where(better, run + d, step)
        cost = np.where((at >= -1) & (at < len(text)), step, far)
        if cost.min() > edits:
            return None
    k = int(cost.argmin())
    return (int(cost[k]), int(start[k]), int(low + k + len(item))) if cost[k] <= edits else None


def _find(batches, items):
    names = ["doc_id", "item_id", "edits", "start", "end"]
    for b in batches:
        out = [(i, items.value.ids[k], *rest) for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True) for k, *rest in items.value.matches(t.as_py())]
        cols = list(zip(*out, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], names=names)


def _clean(batches, items, text: int):
    for b in batches:
        yield b.filter(pa.array([not items.value.matches(t.as_py()) for t in b.column(text)], pa.bool_()))


def _blocks(benchmark: DataFrame, rate: float) -> Iterator:
    """Broadcasts of the items, each of about ``BLOCK_CHARS`` characters."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null and item_id is not null")
    items = Saved(items.where(F.length(F.trim("text")) > 0), "items").df
    n = -(-(items.agg(F.sum(F.length("text"))).first()[0] or 0) // BLOCK_CHARS)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        if rows:
            yield spark.sparkContext.broadcast(Items([(r.item_id, r.text) for r in rows], rate))


def find(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """``(doc_id, item_id, edits, start, end)``: each item's best occurrence in each document that holds it."""
    bounded_batches(docs.sparkSession)
    rows, schema = docs.select(F.col("doc_id").cast("long"), "text"), "doc_id long, item_id long, edits long, start long, end long"
    out = docs.sparkSession.createDataFrame([], schema)
    for items in _blocks(benchmark, rate):
        out = out.union(rows.mapInArrow(partial(_find, items=items), schema))
    return out


def without_matches(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item."""
    bounded_batches(docs.sparkSession)
    for items in _blocks(benchmark, rate):
        docs = docs.mapInArrow(partial(_clean, items=items, text=docs.columns.index("text")), docs.schema)
    return docs
