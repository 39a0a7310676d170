"""Toxicity from the nearest labelled examples by exact TF-IDF cosine.

Terms are words in lower case. A bounded sample of labelled rows (at most ``PER_CLASS`` texts of each label, least id hashes
first) gives the examples; every word that an example holds is a term, none is left out. A term weighs
(1 + log tf) * idf * relevance: document frequencies are counted over all documents, and the relevance, sqrt(1 + G2) of the
term against the label, is 1 for a word that tells nothing and more for one that does. Plain TF-IDF (relevance 1 for all)
finds neighbours that are alike in their common words; the README has the figures of both.

The examples, ordered so that alike ones are neighbours, form an inverted index in blocks of ``BLOCK``. Postings of rare terms
are added up exactly. Frequent terms, whose postings would cost most, only bound each block by their greatest weight in it;
blocks are completed from the highest bound down, and those whose bound stays under the k-th best cosine are never
completed. Nothing under its bound is lost, so the neighbours are exact.

Neighbours vote with weights that rise with the cosine, corrected for the sampling of each label; votes become scores by
isotonic regression on the examples themselves, each left out in turn. A text without any term gets the share of label 1
among such examples. Evidence: the neighbours' ids and cosines.

Terms are gathered and the model is fitted in one task of an executor, over the bounded sample; the driver only passes the
pickled model on (``train``), since examples, words and index unpacked there would stay in its memory.

Defined cases: null and empty texts have no terms; a text of any length is read whole (but one over ``EXAMPLE_CHARS`` is no
example); a null label or id is not learned from; rows with equal ids are scored each by its own text, and the label counts 1
if any of the id's labels is 1; with no label 1 or no label 0 to learn from, every score is the share of label 1 (0 if there
are no labels); equal cosines (to nine digits) go by the example's place; an empty table gives an empty result. Other columns
of the documents, whatever their names, never enter a score.
"""

from __future__ import annotations

import ctypes
import pickle
import re
from collections import Counter
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import Saved, bounded_batches

PER_CLASS = 4000
#: Longer texts are not taken as examples, which bounds the task that fits.
EXAMPLE_CHARS = 1 << 18
NEIGHBOURS = 15
BLOCK = 32
#: Terms whose postings are bounded by blocks: the most frequent, at most so many, in at least this share of the examples.
FREQUENT, FREQUENT_SHARE = 512, 0.04
#: Queries searched together, and blocks that each completes first.
BATCH, FIRST = 48, 4
THRESHOLD = 0.7
_WORD = re.compile(r"\w+")
#: ASCII characters that no word holds become spaces.
_BLANKS = bytes(c if c >= 128 or _WORD.match(chr(c)) else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """The matches of ``\\w+`` in lower case as UTF-8; without a regex where all other characters are letters or digits."""
    low = (text or "").lower()
    if low.isascii() or all(c.isalnum() for c in set(low) if c > "\x7f"):
        return low.encode().translate(_BLANKS).split()
    return [w.encode("utf-8", "replace") for w in _WORD.findall(low)]


def _ragged(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = ends - starts
    return np.repeat((starts - np.cumsum(n) + n).astype(np.int32), n) + np.arange(n.sum(), dtype=np.int32)


class Terms:
    """Words by number; pickled as one string of bytes, since very many small objects would take the driver's memory."""

    def __init__(self, words: list[bytes]):
        self.number = {w: j for j, w in enumerate(words)}

    def __getstate__(self):
        return b"\n".join(self.number)

    def __setstate__(self, state):
        self.__init__(state.split(b"\n") if state else [])

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """A text's terms by number and how often each occurs."""
        count = Counter(map(self.number.get, words(text)))
        count.pop(None, None)
        return np.fromiter(count, np.int64, len(count)), np.fromiter(count.values(), float, len(count))


class Packed:
    """A pickled value that is passed on as it is: whoever unpickles this gets the value, as workers do from a broadcast."""

    def __init__(self, data: bytes):
        self.data = data

    def __reduce__(self):
        return pickle.loads, (self.data,)

    def value(self):
        return pickle.loads(self.data)


class BlockMaxIndex:
    """Exact top-k cosine over sparse unit vectors ``(terms, weights)``."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.n = len(vectors)
        self.n_blocks = -(-self.n // BLOCK)
        self.width = self.n_blocks * BLOCK
        none = np.zeros(0, np.int64)
        ex = np.repeat(np.arange(self.n), [len(t) for t, _ in vectors])
        term, weight = (np.concatenate([v[c] for v in vectors] or [none]) for c in (0, 1))
        order = np.lexsort((ex, term))
        ex, term, weight = ex[order], term[order].astype(np.int64), weight[order]
        held = np.bincount(term, minlength=n_terms)
        often = np.argsort(-held, kind="stable")[:FREQUENT]
        often = np.sort(often[held[often] > max(BLOCK, FREQUENT_SHARE * self.n)])
        self.slot = np.full(n_terms, -1, np.int32)
        self.slot[often] = np.arange(len(often))
        rare = self.slot[term] < 0
        self.example, self.weight = ex[rare].astype(np.int32), weight[rare]
        self.first = np.searchsorted(term[rare], np.arange(n_terms + 1))
        self.often = len(often), self.slot[term[~rare]], ex[~rare].astype(np.int32), weight[~rare]
        self._spread()

    def _spread(self) -> None:
        n, slot, ex, weight = self.often
        self.many = np.zeros((n, self.width))
        self.many[slot, ex] = weight
        self.most = self.many.reshape(n, self.n_blocks, BLOCK).max(axis=2) if self.n else self.many

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("many", "most")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._spread()

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, skip: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the places and cosines of its k nearest with a cosine over 0, nearest first, ties by place."""
        return [x for at in range(0, len(queries), BATCH) for x in self._search(queries[at : at + BATCH], k, None if skip is None else skip[at : at + BATCH])]

    def _search(self, queries, k: int, skip):
        n = len(queries)
        who = np.repeat(np.arange(n), [len(t) for t, _ in queries])
        term, weight = (np.concatenate([q[c] for q in queries]) for c in (0, 1))
        slot = self.slot[term]
        often, rare = np.flatnonzero(slot >= 0), np.flatnonzero(slot < 0)
        q = np.zeros((n, len(self.many)))
        q[who[often], slot[often]] = weight[often]
        a, b = self.first[term[rare]], self.first[term[rare] + 1]
        post, length = _ragged(a, b), b - a
        cell = np.repeat((who[rare] * self.width).astype(np.int32), length)
        cell += self.example[post]
        part = np.repeat(weight[rare], length)
        part *= self.weight[post]
        score = np.bincount(cell, part, n * self.width).astype(float).reshape(n, self.width)
        if skip is not None:
            score[np.arange(n), skip] = -np.inf
        bound = score.reshape(n, self.n_blocks, BLOCK).max(axis=2) + q @ self.most
        first = np.argsort(-bound, axis=1, kind="stable")[:, :FIRST]
        done = np.zeros((n, self.n_blocks), bool)
        np.put_along_axis(done, first, True, axis=1)
        self._complete(score, q, done)
        best = np.take_along_axis(score.reshape(n, self.n_blocks, BLOCK), first[:, :, None], axis=1).reshape(n, -1)
        least = -np.partition(-best, k - 1, axis=1)[:, k - 1] if best.shape[1] > k else np.full(n, -np.inf)
        self._complete(score, q, ~done & (bound >= least[:, None] - 1e-9))
        out = []  # a block that isn't complete holds nothing that reaches ``least``
        for row, enough in zip(score, np.maximum(least - 1e-9, 1e-12), strict=True):
            at = np.flatnonzero(row >= enough)
            cosine = np.round(row[at], 9)
            order = np.lexsort((at, -cosine))[:k]
            out.append((at[order], cosine[order]))
        return out

    def _complete(self, score: np.ndarray, q: np.ndarray, which: np.ndarray) -> None:
        """Add the frequent terms' share to the scores in the blocks that each query asks for."""
        for block in np.flatnonzero(which.any(axis=0)).tolist():
            rows, at = np.flatnonzero(which[:, block]), slice(block * BLOCK, (block + 1) * BLOCK)
            score[rows, at] += q[rows] @ self.many[:, at]


class Model:
    """Fitted from the bounded sample. ``examples`` are ``(id, label, terms, counts)`` with terms as numbers."""

    def __init__(self, terms: Terms, frequency: np.ndarray, n_docs: int, examples: list[tuple[int, int, np.ndarray, np.ndarray]], totals: tuple[float, float], k: int):
        self.terms, self.k = terms, k
        y = np.array([e[1] for e in examples], np.int64)
        n = np.bincount(y, minlength=2)
        self.share = totals[1] / max(1.0, sum(totals))
        self.index = None
        if not n.min():
            self.empty = self.share
            return
        held = [np.bincount(np.concatenate([e[2] for e in examples if e[1] == c]), minlength=len(terms.number)) for c in (0, 1)]
        self.scale = (np.log((1 + n_docs) / (1 + frequency)) + 1) * np.sqrt(1 + g2(held[1], held[0], n[1], n[0]))
        self.prior = np.array([totals[c] / n[c] for c in (0, 1)])
        vectors = [self.vector(t, c) for _, _, t, c in examples]
        nothing = [(e[1], self.prior[e[1]]) for e in examples if not len(e[2])]
        self.empty = (sum(p for v, p in nothing if v) + self.share) / (sum(p for _, p in nothing) + 1)
        kept = [(e[0], e[1], v) for e, v in zip(examples, vectors, strict=True) if len(v[0])]
        kept.sort(key=lambda x: (int(x[2][0][np.argmax(x[2][1])]), x[1], x[0]))
        self.ids, self.y = np.array([x[0] for x in kept], np.int64), np.array([x[1] for x in kept], np.int64)
        self.index = BlockMaxIndex([x[2] for x in kept], len(terms.number))
        votes = [self.vote(*x) for x in self.index.search([x[2] for x in kept], k, np.arange(len(kept)))]
        self.knots = isotonic(np.array(votes), self.y.astype(float), self.prior[self.y])

    def vector(self, term: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = (1 + np.log(count.astype(float))) * self.scale[term]
        return term, w / np.linalg.norm(w) if len(w) else w

    def vote(self, at: np.ndarray, cosine: np.ndarray) -> float:
        w = self.prior[self.y[at]] * cosine**2
        return float((w @ self.y[at] + 1e-3 * self.share) / (w.sum() + 1e-3))

    def scores(self, texts: list[str | None]) -> list[tuple[float, list[int], list[float]]]:
        if self.index is None:
            return [(self.empty, [], [])] * len(texts)
        out: list = [(self.empty, [], [])] * len(texts)
        counted = [self.terms.of(t) for t in texts]
        some = [j for j, (term, _) in enumerate(counted) if len(term)]
        near = self.index.search([self.vector(*counted[j]) for j in some], self.k)
        for j, (at, cosine) in zip(some, near, strict=True):
            out[j] = float(np.interp(self.vote(at, cosine), *self.knots)), self.ids[at].tolist(), cosine.tolist()
        return out

    def score(self, text: str | None) -> tuple[float, list[int], list[float]]:
        return self.scores([text])[0]


def g2(a: np.ndarray, b: np.ndarray, n1: float, n0: float) -> np.ndarray:
    """Likelihood-ratio statistic of terms that a of n1 texts and b of n0 texts hold."""
    share = (a + b) / (n1 + n0)
    with np.errstate(divide="ignore", invalid="ignore"):
        part = lambda x, m, p: np.where(x > 0, x * np.log(x / (m * p)), 0.0)
        return np.maximum(0, 2 * (part(a, n1, share) + part(b, n0, share) + part(n1 - a, n1, 1 - share) + part(n0 - b, n0, 1 - share)))


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing fit by pooling neighbours that violate the order."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for v, t, m in zip(x[order], y[order], w[order], strict=True):
        pools.append([t * m, m, v, v])
        while len(pools) > 1 and (pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1] or pools[-2][3] == pools[-1][2]):
            a, b = pools[-2], pools.pop()
            pools[-1] = [a[0] + b[0], a[1] + b[1], a[2], b[3]]
    return np.array([e for p in pools for e in p[2:]]), np.array([p[0] / p[1] for p in pools for _ in range(2)])


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3 == 1


def _counted(batches):
    """Each example's words, one a line, and how often each occurs."""
    for b in batches:
        got = [Counter(words(t.as_py())) for t in b.column(2)]
        cols = [pa.array([b"\n".join(c) for c in got], pa.binary()), pa.array([np.fromiter(c.values(), "<i4", len(c)).tobytes() for c in got], pa.binary())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=["doc_id", "y", "words", "counts"])


def _frequencies(batches, terms):
    number = terms.value.number
    n, seen = 0, np.zeros(len(number), np.int64)
    for b in batches:
        for text in b.column(0):
            n += 1
            at = set(map(number.get, set(words(text.as_py()))))
            at.discard(None)
            seen[list(at)] += 1
    some = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, some]), pa.array(np.r_[n, seen[some]])], names=["term", "n"])


def _release() -> None:
    """Give freed memory back to the system, where the C library can; a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _vocabulary(batches):
    """The pickled terms of all examples."""
    seen: set[bytes] = set()
    for b in batches:
        for ws in b.column(2):
            seen.update(ws.as_py().split(b"\n"))
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(Terms(sorted(seen - {b""})))], pa.binary())], names=["data"])


def _fitted(batches, terms, found: tuple[np.ndarray, np.ndarray], totals: tuple[float, float], k: int):
    """The pickled model; ``found``: terms by number with their document frequency, and at -1 the number of documents."""
    number, (at, n) = terms.value.number, found
    frequency = np.zeros(len(number))
    frequency[at[at >= 0]] = n[at >= 0]
    rows = [(i.as_py(), y.as_py(), ws.as_py().split(b"\n"), c.as_py()) for b in batches for i, y, ws, c in zip(*b.columns, strict=True)]
    rows.sort()
    examples = [(i, y, np.array([number[w] for w in ws if w], np.int32), np.frombuffer(c, "<i4").astype(np.float32)) for i, y, ws, c in rows]
    del rows
    data = pickle.dumps(Model(terms.value, frequency, int(n[at < 0].sum()), examples, totals, k))
    del examples
    _release()
    yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["data"])


def _packed(rows: DataFrame) -> Packed:
    return Packed(rows.toArrow().column(0)[0].as_py())


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, k: int = NEIGHBOURS) -> Packed:
    """The model, pickled by the task that fitted it."""
    spark = docs.sparkSession
    bounded_batches(spark)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("y"))
    known = Saved(known.where(~held_out()), "labels").df
    totals = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    some = [known.where(F.col("y") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= EXAMPLE_CHARS)
    sample = sample.join(F.broadcast(some[0].union(some[1])), "doc_id")
    once = sample.groupBy("y", F.sha2("text", 256).alias("h")).agg(F.first("text").alias("text"), F.min("doc_id").alias("doc_id"))
    rows = once.select("doc_id", "y", "text").mapInArrow(_counted, "doc_id long, y int, words binary, counts binary")
    rows = Saved(rows, "examples").df.coalesce(1)
    shared = spark.sparkContext.broadcast(_packed(rows.mapInArrow(_vocabulary, "data binary")))
    counted = docs.select("text").mapInArrow(partial(_frequencies, terms=shared), "term long, n long")
    found = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    found = tuple(found[c].to_numpy() for c in ("term", "n"))
    totals = float(totals.get(0, 0)), float(totals.get(1, 0))
    model = _packed(rows.mapInArrow(partial(_fitted, terms=shared, found=found, totals=totals, k=k), "data binary"))
    shared.unpersist()
    return model


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, k: int = NEIGHBOURS) -> Model:
    """The model itself, unpacked where this is called."""
    return train(docs, labels, per_class, k).value()


def _scores(batches, model, text: int, below: float | None):
    for b in batches:
        got = [x for at in range(0, b.num_rows, BATCH) for x in model.value.scores(b.column(text).slice(at, BATCH).to_pylist())]
        if below is not None:
            yield b.filter(pa.array([s < below for s, _, _ in got], pa.bool_()))
        else:
            cols = [pa.array([g[k] for g in got], t) for k, t in enumerate((pa.float64(), pa.list_(pa.int64()), pa.list_(pa.float64())))]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, "score", "neighbours", "cosines"])


def score(docs: DataFrame, model: Model | Packed) -> DataFrame:
    """``(doc_id, score, neighbours, cosines)`` for every row."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = rows.mapInArrow(partial(_scores, model=shared, text=1, below=None), "doc_id long, text string, score double, neighbours array<long>, cosines array<double>")
    return out.drop("text")


def keep_below(docs: DataFrame, model: Model | Packed, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is under the threshold."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(partial(_scores, model=shared, text=docs.columns.index("text"), below=threshold), docs.schema)
