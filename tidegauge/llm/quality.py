"""Quality from weak labels: heuristic labellers, their accuracies by expectation-maximisation, a hashed linear scorer.

Each labeller looks at one trait of a text and votes good, bad or not at all. Over all documents the votes' patterns are
counted (at most 3 to the number of labellers). On these counts expectation-maximisation fits the share of good texts and,
for each labeller, how often it is right among the good and among the bad texts that it votes on; the labellers overlap on
the texts, and that alone tells who is right, with no labels at hand. Silence is no evidence. Labellers that also err
together see the same thing twice: their votes count less, by how far their errors agree in both classes.

The accuracies give each pattern its posterior, which labels a sample of at most ``SAMPLE`` distinct texts of at most
``EXAMPLE_CHARS`` characters (least text hashes first, each text once at every size of the input). They train a logistic
scorer on hashed features: the shapes of words, alone and in pairs, by their share of the text. It rates every document.

Defined cases: a null text is empty; an empty or blank text gets one vote (bad, for its length) and the scorer's constant;
texts of any length are judged whole; equal texts score alike; other columns, whatever their names, are not read; an empty
table gives an empty result. Labels, language, source and id are never looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import partial
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import bounded_batches

SAMPLE = 20_000
#: Longer texts are scored, but don't train, which bounds the features that the driver collects.
EXAMPLE_CHARS = 1 << 14
#: Words in a block whose distinct words are counted.
DISTINCT_BLOCK = 1000
BITS = 14
ROUNDS = 200
STEPS = 150
GOOD, BAD, NONE = 1, 0, 2
_LETTERS, _UPPER = re.compile(r"[^\W\d_]+"), re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_PLAIN = re.compile(r"[^\W_]+")
_ODD = re.compile(r"[^\w\s.,;:!?'\"()\-|]+")
_END = re.compile(r"[.!?](?!\S)")
_RUN = re.compile(r"(.)\1+", re.S)
_LOWERS, _UPPERS, _DIGITS = re.compile(r"[a-zß-öø-ÿ]+"), re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"\d+")


def _chars(runs: re.Pattern, text: str) -> int:
    """Characters in the runs that a pattern finds; far fewer matches than one for each character."""
    return sum(map(len, runs.findall(text)))


def _distinct(words: list[str]) -> int:
    """Distinct words, block by block, so that the share of a long ordinary text doesn't fall with its length."""
    return sum(len(set(words[k : k + DISTINCT_BLOCK])) for k in range(0, len(words), DISTINCT_BLOCK))


def _vote(value: float, good, bad) -> int:
    return BAD if bad(value) else GOOD if good(value) else NONE


def votes(text: str | None) -> tuple[int, ...]:
    """Length, capitals, exclamation marks, odd characters, bars, word length, sentence ends, distinct words, distinct lines,
    words that follow themselves, share of letters and digits."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return (BAD, *[NONE] * 10)
    letters = _chars(_LETTERS, text) or 1
    ends = len(_END.findall(text))
    lines = [x for x in text.split("\n") if x.strip()]
    return (
        _vote(n, lambda x: x >= 30, lambda x: x < 3),
        _vote(_chars(_UPPER, text) / letters, lambda x: x < 0.15, lambda x: x > 0.4),
        _vote(text.count("!") / n, lambda x: x < 0.02, lambda x: x > 0.15),
        _vote(_chars(_ODD, text) / len(text), lambda x: x < 0.01, lambda x: x > 0.04),
        _vote(text.count("|") / n, lambda x: x == 0, lambda x: x > 0.1),
        _vote(len(text) / n, lambda x: 4 <= x <= 12, lambda x: not 3 <= x <= 16),
        _vote(ends / n, lambda x: 0.02 <= x <= 0.35, lambda x: n >= 30 and not 0.005 <= x <= 0.6),
        _vote(_distinct(words) / n if n >= 50 else 0.45, lambda x: x > 0.5, lambda x: x < 0.3),
        _vote(len(set(lines)) / len(lines) if len(lines) > 3 else 0.75, lambda x: x > 0.9, lambda x: x < 0.6),
        _vote(sum(map(eq, words, words[1:])) / n, lambda x: x < 0.05, lambda x: x > 0.2),
        _vote(_chars(_PLAIN, text) / sum(map(len, words)), lambda x: x > 0.95, lambda x: x < 0.92),
    )


N_LABELLERS = 11


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features: word shapes and pairs of them (marked where the word is the same), by the root of their share."""
    words = (text or "").split()
    shape = _DIGITS.sub("0", _UPPERS.sub("A", _LOWERS.sub("a", text or "")))
    shapes = [w[:8] for w in _RUN.sub(r"\1\1", shape).split()]
    count = Counter(shapes)
    pairs = Counter(zip(shapes, shapes[1:], map(eq, words, words[1:]), strict=False))
    count.update({f"{a}\x00{b}{same}": n for (a, b, same), n in pairs.items()})
    if not count:
        return np.zeros(0, np.int64), np.zeros(0)
    at = np.array([zlib.crc32(s.encode()) & ((1 << BITS) - 1) for s in count], np.int64)
    where, inverse = np.unique(at, return_inverse=True)
    total = np.bincount(inverse, np.array(list(count.values()), float))
    return where, np.sqrt(total / len(shapes))


def _pattern(v: tuple[int, ...]) -> int:
    return sum(x * 3**k for k, x in enumerate(v))


def _patterns(batches):
    count: Counter = Counter()
    for b in batches:
        count.update(_pattern(votes(t.as_py())) for t in b.column(0))
    yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.int64()), pa.array(list(count.values()), pa.int64())], names=["pattern", "n"])


def label_model(counts: dict[int, int], rounds: int = ROUNDS) -> tuple[dict[int, float], np.ndarray]:
    """Each pattern's probability of a good text, and for every labeller how often it is right about bad and good texts.

    Two latent classes. A labeller that votes says "bad" with one probability in each class; expectation-maximisation fits
    these and the classes' shares, from a start where texts with no bad vote are probably good, with two or more probably
    bad, and with one undecided. The posterior adds up the votes' log-likelihood ratios. A labeller counts 1 / (1 + sum of
    its error correlations with the others), taken where the errors agree in both classes (faults of one kind agree among
    bad texts only), scaled so that the labellers count 1 on average.
    """
    pattern = np.array(sorted(counts), np.int64)
    n = np.array([counts[p] for p in pattern.tolist()], float)
    said = np.stack([pattern // 3**k % 3 for k in range(N_LABELLERS)], axis=1)
    bad, good = (said == BAD).astype(float), (said == GOOD).astype(float)
    voted = bad + good
    post = np.choose(np.minimum(bad.sum(axis=1), 2).astype(int), [0.95, 0.5, 0.05])
    for _ in range(rounds):
        rate, shared = [], np.ones((N_LABELLERS, N_LABELLERS))
        for mass, usual in ((n * (1 - post), 0.7), (n * post, 0.05)):
            rate.append((mass @ bad + usual) / (mass @ voted + 1))
            off = voted * (bad - rate[-1])
            together = (off * mass[:, None]).T @ off
            spread = np.sqrt(np.diag(together))
            shared = np.minimum(shared, np.clip(together / (np.outer(spread, spread) + 5), 0, 1))
        np.fill_diagonal(shared, 0)
        weight = 1 / (1 + shared.sum(axis=1))
        weight /= weight.mean()
        share = (n @ post + 1) / (n.sum() + 2)
        log = np.log(share / (1 - share)) + bad @ (weight * np.log(rate[1] / rate[0])) + good @ (weight * np.log((1 - rate[1]) / (1 - rate[0])))
        before, post = post, 1 / (1 + np.exp(-np.clip(log, -30, 30)))
        if np.abs(post - before).max() < 1e-9:
            break
    return dict(zip(pattern.tolist(), post.tolist(), strict=True)), np.stack([rate[0], 1 - rate[1]], axis=1)


def train(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Logistic regression with soft targets, classes weighed alike, by full-batch Adam; always the same result."""
    size = 1 << BITS
    row = np.repeat(np.arange(len(rows)), [len(a) for a, _ in rows])
    col, val = (np.concatenate([r[k] for r in rows]) if rows else np.zeros(0, np.int64) for k in (0, 1))
    w, m, s = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    if not len(rows):
        return w[:size], 0.0
    weight = target / max(target.sum(), 1e-9) + (1 - target) / max((1 - target).sum(), 1e-9)
    for t in range(1, steps + 1):
        z = np.bincount(row, w[col] * val, len(rows)) + w[size]
        d = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target)
        g = np.append(np.bincount(col, d[row] * val, size), d.sum()) + 1e-5 * w
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-9)
    return w[:size], float(w[size])


def _sampled(batches):
    for b in batches:
        got = [(_pattern(votes(t.as_py())), *features(t.as_py())) for t in b.column(0)]
        cols = [pa.array([g[k].astype(t).tobytes() for g in got], pa.binary()) for k, t in ((1, "<i2"), (2, "<f4"))]
        yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), *cols], names=["pattern", "at", "x"])


def _scored(batches, model):
    w, b0 = model.value
    for b in batches:
        score = []
        for t in b.column(1):
            at, x = features(t.as_py())
            score.append(float(1 / (1 + np.exp(-np.clip(w[at] @ x + b0, -30, 30)))))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64())], names=["doc_id", "score"])


def score(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, score)``: the scorer's probability of a good text."""
    spark = docs.sparkSession
    bounded_batches(spark)
    counts = docs.select("text").mapInArrow(_patterns, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    post = label_model({r.pattern: r.n for r in counts})[0] if counts else {}
    few = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text")).where(F.length("text") <= EXAMPLE_CHARS)
    last = few.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    few = few.where(F.col("h") <= last).dropDuplicates(["h"]) if last is not None else few.limit(0)
    rows = few.select("text").mapInArrow(_sampled, "pattern long, at binary, x binary").toArrow()
    rows = sorted(zip(*(c.to_pylist() for c in rows.columns), strict=True))
    examples = [(np.frombuffer(at, "<i2").astype(np.int64), np.frombuffer(x, "<f4").astype(float)) for _, at, x in rows]
    w, b0 = train(examples, np.array([post[p] for p, _, _ in rows]))
    model = spark.sparkContext.broadcast((w, b0))
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(partial(_scored, model=model), "doc_id long, score double")
