"""Removal of long strings that earlier documents hold already, by a sparse suffix array built with a distributed merge.

A string of ``LENGTH`` bytes is judged where it starts. Of all its K-grams the one with the least hash is its anchor; equal
strings have equal anchors at equal places, so only anchors are sorted: about one suffix in fourteen. The steps:

1. Texts are packed into chunk files in the shared folder. Each chunk sends the hashes of its anchors, once each.
2. Anchors whose hash occurs in one document only are dropped: none of their strings can repeat.
3. Each chunk sorts the suffixes at the rest, with the bytes before them, into runs, one for each partition of the K-gram,
   and sends them front-coded: a suffix is its common prefix with the one before and the bytes that follow. Equal records
   of a chunk go once, with the least document.
4. A partition merges its runs with a loser tree that carries common prefix lengths: a suffix is compared only from where
   it is known to agree with the last winner, and not at all where those lengths differ. The merged common prefixes give
   every suffix its class at each length; sorting the bytes before the anchors gives classes likewise. A string is the
   pair of both, and takes the least document of its pair. No hash decides: equal classes are equal bytes.
5. Each chunk marks its strings from the answers, joins them into runs of bytes and digests what is left.

Anchors found in more than ``HOT`` chunks are not sent as suffixes with all that surrounds them: each of their strings is
dealt by its own bytes, so a passage that very many documents share spreads over all partitions.

Buckets and partitions go by number, one to a task, so no two share one by chance. Chunks, buckets and partitions have
bounded size: their number follows the total of bytes, up to ``MOST``. A chunk holds at
least one whole document. Not all of an answer comes through the merge: step 2 drops anchors by hashes before anything is
sorted, and the bytes before the anchors are sorted within their partition in step 4; both are exact.

Defined cases: null text is empty; a text of any length is judged whole; a row with a null id neither removes nor loses
anything; equal ids don't affect each other (a smaller id is asked for); repeated rows are judged alike; other columns,
whatever their names, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import Saved, bounded_batches, new_path
from tidegauge.llm.dac import _put, get

LENGTH, K = 50, 24
SPAN = LENGTH - K + 1
CHUNK_BYTES = 1 << 21
BUCKET_BYTES = 1 << 24
PARTITION_BYTES = 1 << 25
CHUNKS_A_TASK = 8
#: Bytes of text behind a file of what is small beside it.
FILE_TEXT = 1 << 27
#: Buckets and partitions at least, so that a small input is dealt out too, and at most, as far as the hash tells them apart:
#: with 2^24 they grow over the sizes above from 281 TB on.
LEAST, MOST = 32, 1 << 24
HOT = 2048
RECORD = LENGTH + SPAN - 1 + 3
NO_DOC = np.iinfo(np.int64).max


class Chunk:
    """Documents packed one behind the other."""

    def __init__(self, ids: np.ndarray, valid: np.ndarray, lens: np.ndarray, data: bytes):
        self.ids, self.valid, self.lens, self.data = ids, valid, lens, data
        self.ends = np.cumsum(lens)
        self.starts = self.ends - lens

    def dump(self) -> bytes:
        head = np.array([len(self.ids)], "<i8").tobytes()
        return zstandard.ZstdCompressor(level=1).compress(head + self.ids.tobytes() + self.lens.tobytes() + self.valid.tobytes() + self.data)

    @staticmethod
    def load(uri: str) -> Chunk:
        raw = zstandard.ZstdDecompressor().decompress(get(uri))
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        at = 8 + 16 * n
        return Chunk(np.frombuffer(raw, "<i8", n, 8), np.frombuffer(raw, np.uint8, n, at), np.frombuffer(raw, "<i8", n, 8 + 8 * n), raw[at + n :])


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes at every position, as integers."""
    n = len(data) - 7
    out = np.empty(n, "<u8")
    for r in range(min(8, n)):
        whole = (n - r + 7) // 8
        out[r::8] = np.frombuffer(data, "<u8", whole, r)
    return out


def _mix(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _gram_hash(w: np.ndarray) -> np.ndarray:
    """Hashes of the K-grams; w: what _words gives."""
    n = len(w) - (K - 8)
    h = w[:n] * np.uint64(0xA24BAED4963EE407)
    h ^= w[8 : n + 8] * np.uint64(0x9FB21C651E98DF25) + (h >> np.uint64(31))
    h ^= w[16 : n + 16] * np.uint64(0xC2B2AE3D27D4EB4F) + (h >> np.uint64(29))
    return _mix(h)


def anchors(chunk: Chunk, block: int = 1 << 15) -> tuple[np.ndarray, ...]:
    """``(anchor, first start, last start, document, hash)`` of every anchor, by position. Strings never cross documents.

    Blocks are small, so that what is computed for one stays in the processor's cache.
    """
    data = np.frombuffer(chunk.data, np.uint8)
    n = len(data) - LENGTH + 1
    fits = np.zeros(max(n, 0) + 1, np.int8)
    long = (chunk.lens >= LENGTH) & (chunk.valid == 1)
    np.add.at(fits, chunk.starts[long], 1)
    np.add.at(fits, chunk.ends[long] - LENGTH + 1, -1)
    fits = np.cumsum(fits[:-1], dtype=np.int8).astype(bool)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    for carry in range(0, max(n, 0), block):
        part = np.ascontiguousarray(data[carry : carry + block + LENGTH - 1])
        h = _gram_hash(_words(part))
        v = (h & np.uint64(0xFFFFFFFFFFE00000)) | np.arange(len(h), dtype=np.uint64)
        m = np.minimum(v[:-1], v[1:])
        m = np.minimum(m[:-2], m[2:])
        m = np.minimum(m[:-4], m[4:])
        m = np.minimum(m[:-8], m[8:])
        m = np.minimum(m[: len(part) - LENGTH + 1], m[SPAN - 16 : SPAN - 16 + len(part) - LENGTH + 1])
        starts = np.flatnonzero(fits[carry : carry + len(m)])
        if len(starts):
            at = (m[starts] & np.uint64(0x1FFFFF)).astype(np.int64)
            new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)])
            last = np.r_[new[1:], len(starts)] - 1
            found.append((at[new] + carry, starts[new] + carry, starts[last] + carry, h[at[new]]))
    at, start, end, h = (np.concatenate(x) for x in zip(*found, strict=True))
    # an anchor may go on in the next block; the starts of two documents are never next to each other
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (start[1:] != end[:-1] + 1)][: len(at)])
    last = np.r_[new[1:], len(at)] - 1 if len(at) else new
    return at[new], start[new], end[last], np.searchsorted(chunk.ends, start[new], side="right"), h[new]


def _filter_keys(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    return ((h >> np.uint64(24)) * np.uint64(buckets) >> np.uint64(40)).astype(np.int64), (h & np.uint64(0xFFFFFFFF)).astype("<u4")


def _by_bucket(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct ``(bucket, key)`` in order, and where each of h is among them."""
    bucket, key = _filter_keys(h, buckets)
    both, inverse = np.unique((bucket.astype(np.uint64) << np.uint64(32)) | key, return_inverse=True)
    return (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(0xFFFFFFFF)).astype("<u4"), inverse


_SENT = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), ("data", pa.binary())])


def _uri(base: str, chunk: int) -> str:
    return f"{base}/chunk-{chunk >> 32:08d}-{chunk & 0xFFFFFFFF:08d}"


def _pack(batches, base: str, buckets: int):
    """Step 1."""
    part, seq, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

    def flush():
        number = part << 32 | seq
        chunk = Chunk(np.array([i or 0 for i in ids], "<i8"), np.array([i is not None for i in ids], np.uint8), np.array([len(t) for t in texts], "<i8"), b"".join(texts))
        _put(_uri(base, number), chunk.dump())
        _, _, _, doc, h = anchors(chunk)
        bucket, key, inverse = _by_bucket(h, buckets)
        own = chunk.ids[doc]
        low, high = np.full(len(key), NO_DOC), np.full(len(key), -NO_DOC - 1)
        np.minimum.at(low, inverse, own)
        np.maximum.at(high, inverse, own)
        several = (low != high).astype(np.uint8)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        rows = [(b, key[x:y].tobytes() + several[x:y].tobytes()) for b, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if y > x] or [(0, b"")]
        return pa.RecordBatch.from_arrays([pa.array([number] * len(rows), pa.int64()), pa.array([b for b, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], schema=_SENT)

    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            text = t.as_py() or b""
            if ids and size + len(text) > CHUNK_BYTES:
                yield flush()
                ids, texts, size, seq = [], [], 0, seq + 1
            ids.append(i)
            texts.append(text)
            size += len(text)
    if ids:
        yield flush()


def _shared(table: pa.Table, hot: int) -> pa.Table:
    """Step 2, for one bucket: for each key of each chunk 0 (in one document), 1 (in several) or 2 (in very many chunks)."""
    keys, several = [], []
    for x in table["data"].to_pylist():
        n = len(x) // 5
        keys.append(np.frombuffer(x, "<u4", n))
        several.append(np.frombuffer(x, np.uint8, n, 4 * n))
    _, inverse, count = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    more = np.bincount(inverse, np.concatenate(several), len(count)) > 0
    kind = np.where(count > hot, 2, (count > 1) | more).astype(np.uint8)[inverse]
    cuts = np.cumsum([0, *map(len, keys)])
    out = [zstandard.compress(kind[a:b].tobytes(), 1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return pa.Table.from_arrays([table["chunk"], table["bucket"], pa.array(out, pa.binary())], schema=_SENT)


class Records:
    """A chunk's records for the merge: suffix, bytes before it backwards, range of places, distinct and sorted."""

    def __init__(self, uri: str, kinds: pa.Table, buckets: int):
        self.chunk = chunk = Chunk.load(uri)
        at, first, last, doc, h = anchors(chunk)
        _, _, inverse = _by_bucket(h, buckets)
        got = sorted(zip(kinds["bucket"].to_pylist(), kinds["data"].to_pylist(), strict=True))
        kind = np.frombuffer(b"".join(zstandard.decompress(x) for _, x in got), np.uint8)[inverse] if len(h) else np.zeros(0, np.uint8)
        data = np.concatenate([np.zeros(SPAN, np.uint8), np.frombuffer(chunk.data, np.uint8), np.zeros(LENGTH, np.uint8)])
        one, many = np.flatnonzero(kind == 1), np.flatnonzero(kind == 2)
        n_hot = last[many] - first[many] + 1
        hot = np.repeat(first[many] - np.cumsum(n_hot) + n_hot, n_hot) + np.arange(n_hot.sum())
        pos, lo, hi = np.r_[at[one], hot], np.r_[at[one] - last[one], np.zeros(len(hot), np.int64)], np.r_[at[one] - first[one], np.zeros(len(hot), np.int64)]
        self.pos, self.lo, self.hi, self.doc = pos, lo, hi, np.r_[doc[one], np.repeat(doc[many], n_hot)]
        rows = np.zeros((len(pos), RECORD), np.uint8)
        view = np.lib.stride_tricks.sliding_window_view(data, LENGTH)
        rows[:, :LENGTH] = view[pos + SPAN]
        left = chunk.ends[self.doc] - pos
        rows[:, :LENGTH] *= np.arange(LENGTH)[None, :] < left[:, None]
        before = np.lib.stride_tricks.sliding_window_view(data, SPAN - 1)[pos + 1][:, ::-1]
        rows[:, LENGTH : RECORD - 3] = before * (np.arange(SPAN - 1)[None, :] < hi[:, None])
        rows[:, RECORD - 3], rows[:, RECORD - 2], rows[:, RECORD - 1] = lo + 1, hi + 1, np.r_[np.ones(len(one)), np.full(len(hot), 2)]
        flat = np.ascontiguousarray(rows).view(f"S{RECORD}").ravel()
        _, index, self.inverse = np.unique(flat, return_index=True, return_inverse=True)
        self.rows = rows[index]
        own = chunk.ids[self.doc]
        self.least = np.full(len(index), NO_DOC)
        np.minimum.at(self.least, self.inverse, own)
        self.later = own > self.least[self.inverse]

    def partition(self, parts: int) -> np.ndarray:
        w = np.ascontiguousarray(np.pad(self.rows[:, :LENGTH], ((0, 0), (0, 6)))).view("<u8")
        few = w.copy()
        few[self.rows[:, RECORD - 1] == 1, 3:] = 0
        h = np.zeros(len(few), np.uint64)
        for k in range(few.shape[1]):
            h = _mix(h ^ (few[:, k] + np.uint64(k)))
        return ((h >> np.uint64(40)) * np.uint64(parts) >> np.uint64(24)).astype(np.int64)


_RUNS = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("run", pa.binary())])


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1]).astype(np.uint8)


def encode_run(rows: np.ndarray, least: np.ndarray) -> bytes:
    """Front-coded: counts, common prefixes, what follows them, then the other fields."""
    suffix = rows[:, :LENGTH]
    lcp = np.r_[np.uint8(0), _common(suffix[1:], suffix[:-1])].astype(np.uint8) if len(rows) else np.zeros(0, np.uint8)
    rest = suffix[np.arange(LENGTH)[None, :] >= lcp[:, None]]
    return np.array([len(rows), len(rest)], "<i8").tobytes() + least.astype("<i8").tobytes() + lcp.tobytes() + rest.tobytes() + np.ascontiguousarray(rows[:, LENGTH:]).tobytes()


class Run:
    def __init__(self, data: bytes):
        n, rest = (int(x) for x in np.frombuffer(data, "<i8", 2))
        at = 16
        self.least, at = np.frombuffer(data, "<i8", n, at), at + 8 * n
        self.lcp, at = data[at : at + n], at + n
        self.rest, at = data[at : at + rest], at + rest
        self.other = np.frombuffer(data, np.uint8, n * (RECORD - LENGTH), at).reshape(n, RECORD - LENGTH)
        self.n = n

    def __iter__(self):
        """``(suffix, common prefix with the one before)``."""
        at, now = 0, b""
        for c in self.lcp:
            end = at + LENGTH - c
            now = now[:c] + self.rest[at:end]
            at = end
            yield now, c


def merge(runs: list) -> tuple[np.ndarray, np.ndarray]:
    """The runs' numbers in merged order, and each suffix's common prefix with the one before it.

    A loser tree. Each run's head carries its common prefix with the last winner. Of two heads the one that agrees longer
    is the less, without a look at their bytes; at equal lengths they are compared from there on, and the loser takes
    along how far they agree.
    """
    size = 1 << max(0, (len(runs) - 1).bit_length())
    streams = [iter(r) for r in runs]
    head: list = [next(s, None) for s in streams] + [None] * (size - len(runs))
    text = [h[0] if h else None for h in head]
    lcp = [0] * size
    nodes = [-1] * size
    order, prefixes = [], []

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; of equal suffixes the first run's wins."""
        x, y = text[a], text[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        la, lb = lcp[a], lcp[b]
        if la != lb:
            return (a, b) if la > lb else (b, a)
        u, v = x[la:], y[la:]
        if u == v:
            w, out = (a, b) if a < b else (b, a)
            lcp[out] = LENGTH
            return w, out
        w, out = (a, b) if u < v else (b, a)
        differ = int.from_bytes(u, "big") ^ int.from_bytes(v, "big")
        lcp[out] = LENGTH - (differ.bit_length() + 7) // 8
        return w, out

    level = list(range(size))
    at = size
    while at > 1:
        at //= 2
        after = []
        for k in range(at):
            w, out = play(level[2 * k], level[2 * k + 1])
            nodes[at + k] = out
            after.append(w)
        level = after
    winner = level[0]
    while text[winner] is not None:
        order.append(winner)
        prefixes.append(lcp[winner])
        got = next(streams[winner], None)
        if got is None:
            text[winner] = None
        else:
            text[winner], lcp[winner] = got
        node = (winner + size) >> 1
        while node:
            other = nodes[node]
            x, y = text[winner], text[other]
            if y is not None:
                la, lb = lcp[winner], lcp[other]
                if x is None or la < lb:
                    nodes[node], winner = winner, other
                elif la == lb:
                    winner, nodes[node] = play(winner, other)
            node >>= 1
    return np.array(order, np.int64), np.array(prefixes, np.int64)


def _send(key, table: pa.Table, base: str, buckets: int, parts: int) -> pa.Table:
    """Step 3, for one chunk."""
    chunk = key[0].as_py()
    r = Records(_uri(base, chunk), table, buckets)
    part = r.partition(parts)
    out = [(int(q), encode_run(r.rows[part == q], r.least[part == q])) for q in np.unique(part)]
    return pa.Table.from_arrays([pa.array([q for q, _ in out], pa.int32()), pa.array([chunk] * len(out), pa.int64()), pa.array([x for _, x in out], pa.binary())], schema=_RUNS)


def least_documents(lcp: np.ndarray, other: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For merged suffixes: bit i is set where the string that starts i bytes before is in a document before ``doc``."""
    n = len(doc)
    before, lo, hi, hot = other[:, : SPAN - 1], other[:, SPAN - 1].astype(int) - 1, other[:, SPAN].astype(int) - 1, other[:, SPAN + 1]
    by = np.lexsort([before[:, k] for k in range(SPAN - 2, -1, -1)]) if n > 1 else np.arange(n)
    back = np.r_[0, _common(before[by][1:], before[by][:-1])] if n else np.zeros(0, int)
    bits = np.zeros(n, np.uint32)
    for i in range(SPAN):
        sel = np.flatnonzero((lo <= i) & (i <= hi))
        if not len(sel):
            continue
        right = np.cumsum(lcp < LENGTH - i)
        left = np.empty(n, np.int64)
        left[by] = np.cumsum(back < i)
        pair = ((right[sel] * (n + 1) + left[sel]) << 1) | (hot[sel] == 2)
        order = np.argsort(pair, kind="stable")
        new = np.flatnonzero(np.r_[True, pair[order][1:] != pair[order][:-1]])
        least = np.minimum.reduceat(doc[sel][order], new)
        each = np.empty(len(sel), np.int64)
        each[order] = np.repeat(least, np.diff(np.r_[new, len(sel)]))
        bits[sel[doc[sel] > each]] |= np.uint32(1 << i)
    return bits


def _merge(table: pa.Table) -> pa.Table:
    """Step 4, for one partition."""
    runs = [Run(x) for x in table["run"].to_pylist()]
    order, lcp = merge(runs)
    base = np.cumsum([0, *(r.n for r in runs)])
    where = np.argsort(order, kind="stable")
    flat = np.empty(len(order), np.int64)
    flat[where] = np.arange(len(order))
    other, doc = np.concatenate([r.other for r in runs])[flat], np.concatenate([r.least for r in runs])[flat]
    bits = np.empty(len(order), "<u4")
    bits[flat] = least_documents(lcp, other, doc)
    out = [zstandard.compress(bits[a:b].tobytes(), 1) for a, b in zip(base[:-1], base[1:], strict=True)]
    return pa.Table.from_arrays([table["part"], table["chunk"], pa.array(out, pa.binary())], schema=_RUNS)


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _finish(key, kinds: pa.Table, answers: pa.Table, base: str, buckets: int, parts: int, full: bool) -> pa.Table:
    """Step 5, for one chunk."""
    r = Records(_uri(base, key[0].as_py()), kinds, buckets)
    c, part = r.chunk, r.partition(parts)
    bits = np.zeros(len(r.rows), np.uint32)
    for q, x in zip(answers["part"].to_pylist(), answers["run"].to_pylist(), strict=True):
        bits[part == q] = np.frombuffer(zstandard.decompress(x), "<u4")
    each = bits[r.inverse]
    each[r.later] = np.uint32(0xFFFFFFFF)
    cover = np.zeros(len(c.data) + 1, np.int32)
    for i in range(SPAN):
        start = r.pos[(each >> np.uint32(i) & np.uint32(1)).astype(bool) & (r.lo <= i) & (i <= r.hi)] - i
        np.add.at(cover, start, 1)
        np.add.at(cover, start + LENGTH, -1)
    gone = np.cumsum(cover[:-1]) > 0
    data, out = np.frombuffer(c.data, np.uint8), []
    for i, ok, a, b in zip(c.ids.tolist(), c.valid.tolist(), c.starts.tolist(), c.ends.tolist(), strict=True):
        g = gone[a:b]
        removed = int(g.sum())
        spans = int(np.count_nonzero(np.diff(g.astype(np.int8), prepend=0) == 1)) if removed else 0
        kept = data[a:b][~g].tobytes() if removed else c.data[a:b]
        out.append((i if ok else None, b - a, removed, spans, hashlib.sha256(kept).hexdigest(), kept))
    cols = list(zip(*out, strict=True))
    arrays = [pa.array(x, f.type) for x, f in zip(cols, _RESULT, strict=False)]
    if full:
        return pa.Table.from_arrays([*arrays, pa.array(cols[5], pa.binary())], schema=_RESULT.append(pa.field("kept", pa.binary())))
    return pa.Table.from_arrays(arrays, schema=_RESULT)


def deduplicate(docs: DataFrame, full: bool = False, hot: int = HOT) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` for every row; with ``full`` also the bytes ``kept``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets, parts = (min(MOST, max(LEAST, -(-total // size))) for size in (BUCKET_BYTES, PARTITION_BYTES))
    base = new_path(spark, f"chunks-{uuid.uuid4().hex}")
    tasks = max(8, -(-total // (CHUNKS_A_TASK * CHUNK_BYTES)))  # by the text behind the rows: the rows themselves are small
    sent = texts.mapInArrow(partial(_pack, base=base, buckets=buckets), "chunk long, bucket int, data binary").repartitionById(buckets, "bucket")
    # What these steps give is far smaller than the text they work on: many tasks, few files, none written while they work.
    files = max(4, -(-total // FILE_TEXT))
    kinds = sent.groupBy("bucket").applyInArrow(_table(_shared, hot=hot), "chunk long, bucket int, data binary").repartition(files)
    kinds = Saved(kinds, "kinds", few_files=False).df.repartition(tasks, "chunk")
    runs = kinds.groupBy("chunk").applyInArrow(_keyed(_send, base=base, buckets=buckets, parts=parts), "part int, chunk long, run binary").repartitionById(parts, "part")
    answers = runs.groupBy("part").applyInArrow(_table(_merge), "part int, chunk long, run binary").repartition(files)
    answers = Saved(answers, "answers", few_files=False).df.repartition(tasks, "chunk")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if full else "")
    out = kinds.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_keyed_pair(_finish, base=base, buckets=buckets, parts=parts, full=full), schema)
    return out if full else out.repartition(files)


def _table(f, **options):
    return lambda table: f(table, **options)


def _keyed(f, **options):
    return lambda key, table: f(key, table, **options)


def _keyed_pair(f, **options):
    return lambda key, left, right: f(key, left, right, **options)


#: Every string of the input against the least document that holds it; bytes as pairs of hexadecimal digits.
ORACLE = f"""with d as (select row_number() over () rid, doc_id, hex(encode(coalesce(text, ''))) hx from documents),
n as (select *, len(hx) // 2 n_bytes from d),
s as (select rid, doc_id, p, substring(hx, cast(2 * p + 1 as bigint), {2 * LENGTH}) sub from (select *, unnest(range(n_bytes - {LENGTH - 1})) p from n)),
f as (select sub, min(doc_id) least from s group by sub having count(*) > 1),
r as (select rid, p, p > lag(p) over (partition by rid order by p) + {LENGTH} is_new from s join f using (sub) where least < doc_id),
g as (select rid, p, sum(coalesce(is_new, true)::int) over (partition by rid order by p rows unbounded preceding) run from r),
runs as (select rid, min(p) a, max(p) + {LENGTH} b from g group by rid, run),
cut as (select rid, a, b, coalesce(lag(b) over (partition by rid order by a), 0) before from runs),
kept as (select rid, cast(sum(b - a) as bigint) n_removed, cast(count(*) as bigint) n_spans, max(b) tail,
  string_agg(substring(hx, cast(2 * before + 1 as bigint), cast(2 * (a - before) as bigint)), '' order by a) head from cut join n using (rid) group by rid)
select doc_id, cast(n_bytes as bigint) n_bytes, coalesce(n_removed, 0) n_removed, coalesce(n_spans, 0) n_spans,
  sha256(unhex(case when head is null then hx else head || substring(hx, cast(2 * tail + 1 as bigint)) end)) kept_sha256 from n left join kept using (rid)"""
