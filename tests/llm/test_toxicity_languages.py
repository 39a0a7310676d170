import math
import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from tidegauge.llm import queries, toxicity
from tidegauge.llm.common import table


def test_terms_of_a_small_language_count(spark):
    """Five of sixty toxic examples share the word of another language; that must do for a text with this word."""
    ids = [r.doc_id for r in spark.range(400).toDF("doc_id").where(~toxicity.held_out()).limit(120).collect()]
    text = lambda k: "eres un tonto hoy" if k < 5 else "you idiot here" if k < 60 else f"eres muy bueno hoy v{k}" if k < 80 else f"you are kind here v{k}"
    docs = spark.createDataFrame([(i, f"{text(k)} n{k}") for k, i in enumerate(ids)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(k < 60)) for k, i in enumerate(ids)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert b"tonto" in model.terms.number
    assert model.score("un tonto v1")[0] >= toxicity.THRESHOLD and model.score("eres muy bueno")[0] < toxicity.THRESHOLD


def plain_scores(docs, labels):
    """The whole query by dictionaries: every word counts, every example is compared."""
    words = lambda t: re.findall(r"\w+", (t or "").lower())
    known = [(i, y) for i, y in sorted(labels.items()) if i in docs and zlib.crc32(str(i).encode()) % 3 != 1]
    seen, tf, label, ids = set(), [], [], []
    for i, y in known:
        if (y, docs[i]) not in seen:
            seen.add((y, docs[i]))
            tf.append(Counter(words(docs[i])))
            label.append(y)
            ids.append(i)
    n = [label.count(0), label.count(1)]
    totals = [sum(1 for i, y in labels.items() if y == c and zlib.crc32(str(i).encode()) % 3 != 1) for c in (0, 1)]
    held = [Counter(w for t, y in zip(tf, label, strict=True) if y == c for w in t) for c in (0, 1)]
    frequency = Counter(w for t in docs.values() for w in set(words(t)))

    def entropy(a, m):
        return sum(x * math.log(x / m) for x in (a, m - a) if x)

    scale = {}
    for w in set(held[0]) | set(held[1]):
        a, b = held[1][w], held[0][w]
        g2 = 2 * (entropy(a, n[1]) + entropy(b, n[0]) - entropy(a + b, n[0] + n[1]))
        scale[w] = (math.log((1 + len(docs)) / (1 + frequency[w])) + 1) * math.sqrt(1 + max(0, g2))

    def vector(t):
        v = {w: (1 + math.log(c)) * scale[w] for w, c in t.items() if w in scale}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / length for w, x in v.items()}

    examples = [vector(t) for t in tf]
    prior = [totals[c] / n[c] for c in (0, 1)]
    share = totals[1] / sum(totals)

    def vote(q, skip):
        cosines = [(round(sum(x * e.get(w, 0) for w, x in q.items()), 9), k) for k, e in enumerate(examples) if k != skip]
        best = sorted((c for c in cosines if c[0] > 0), key=lambda c: -c[0])
        ties = len(best) > 15 and best[14][0] == best[15][0]
        w = [(prior[label[k]] * c * c, label[k]) for c, k in best[:15]]
        return (sum(x for x, y in w if y) + 1e-3 * share) / (sum(x for x, _ in w) + 1e-3), ties

    votes = [(vote(e, k)[0], y) for k, (e, y) in enumerate(zip(examples, label, strict=True)) if e]
    knots = toxicity.isotonic(np.array([v for v, _ in votes]), np.array([y for _, y in votes], float), np.array([prior[y] for _, y in votes]))
    nothing = [y for e, y in zip(examples, label, strict=True) if not e]
    empty = (prior[1] * sum(nothing) + share) / (sum(prior[y] for y in nothing) + 1)
    out = {}
    for i, t in docs.items():
        v = vector({w: c for w, c in Counter(words(t)).items() if w in scale})
        x, ties = vote(v, -1)
        out[i] = empty if not v else None if ties else float(np.interp(x, *knots))
    return out


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in table(spark, d, "documents").collect()}
    labels = {r.doc_id: int(r.toxic > 0) for r in table(spark, d, "labels").collect() if r.toxic is not None}
    want = plain_scores(docs, labels)
    got = {r.doc_id: r for r in queries.op2_toxicity(spark, d).collect()}
    assert got.keys() == want.keys() and sum(w is not None for w in want.values()) > 0.9 * len(want)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7)
        if want[i] is not None:
            assert abs(r.score - want[i]) < 1e-6, i


def test_long_texts_and_clashing_columns(spark):
    rows = [(k, f"you awful idiot number {k}" if k % 3 == 0 else f"a fine day at the sea {k}") for k in range(300)]
    rows += [(900, "a fine day " * 200_000 + "idiot"), (901, "idiot " * 200_000)]
    df = spark.createDataFrame([(i, t, 0.1, [1], "x", 2) for i, t in rows], "doc_id long, text string, score double, neighbours array<int>, y string, words int")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert got[901] >= toxicity.THRESHOLD > got[900]
    kept = toxicity.keep_below(df, model)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} >= {900, 1, 2}


def test_words():
    for t in ("It's a “test” — naïve_1 x²", "plain ASCII, text!", "ÄÖ\u00a0ß", "", None, "\ud800 bad"):
        assert toxicity.words(t) == [w.encode("utf-8", "replace") for w in re.findall(r"\w+", (t or "").lower())]


def test_driver_unpacks_no_model(spark, monkeypatch):
    """The query and the pipeline's stage fit in an executor; the driver builds neither terms nor model."""
    d = "/root/testdata/sf0.001"

    def refuse(*_):
        raise AssertionError("built on the driver")

    for kind, name in ((toxicity.Model, "__init__"), (toxicity.Terms, "__init__"), (toxicity.BlockMaxIndex, "__setstate__")):
        monkeypatch.setattr(kind, name, refuse)
    docs = table(spark, d, "documents")
    n = docs.count()
    assert queries.op2_toxicity(spark, d).count() == n > corpus_pipeline.drop_toxic(spark, docs, d).count() > 0
