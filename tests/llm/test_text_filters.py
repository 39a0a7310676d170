import random
import re

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegauge.llm import decontam, licenses, quality, queries, toxicity
from tidegauge.llm.common import table

DOCS = "doc_id long, text string, score double, item_id long, lang string, _n int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 0.5, 1, "en", 2) for i, t in rows], DOCS)


def plain_best(text, item, edits):
    """Least edits of item against any part of the text, by the whole table."""
    low, it = decontam.normal(text), decontam.normal(item)
    row = [0] * (len(low) + 1)
    for i, c in enumerate(it, 1):
        before, row = row, [i]
        for j, d in enumerate(low, 1):
            row.append(min(before[j - 1] + (c != d), before[j] + 1, row[j - 1] + 1))
    return min(row) if min(row) <= edits else None


def changed(rng, s, n):
    s = list(s)
    for _ in range(n):
        k = rng.randrange(len(s))
        s[k : k + 1] = rng.choice([[], [rng.choice("abcdé ")], [s[k], rng.choice("abc")]])
    return "".join(s)


def test_matches_equal_whole_table():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate((1, 1, 2, 3, 6, 12, 30, 30))] + [(20, "abc"), (21, "ABC"), (22, "x" * 40)]
    index = decontam.Items(items, 0.1)
    texts = [None, "", " ", "abc", "x" * 41]
    for _ in range(120):
        t = " ".join(word() for _ in range(rng.randint(0, 40)))
        item = rng.choice(items)[1]
        at = rng.randint(0, len(t))
        texts.append((t[:at] + changed(rng, item, rng.randint(0, 4)) + t[at:]).upper() if rng.random() < 0.3 else t[:at] + changed(rng, item, rng.randint(0, 4)) + t[at:])
    for t in texts:
        got = {k: e for k, e, _, _ in index.matches(t)}
        want = {}
        for k, (_, item) in enumerate(items):
            e = plain_best(t, item, int(index.edits[k]))
            if e is not None:
                want[k] = e
        assert got == want, t
        for k, e, a, b in index.matches(t):
            assert plain_best(decontam.normal(t)[a:b], items[k][1], e) == e


def test_find_and_filter(spark):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog tonight"), (2, None), (3, " "), (4, "The quick brown fox jumps over the lazy dog tonight"), (None, "zzz")], "item_id long, text string")
    rows = [(1, "so THE QUICK brown\nfox jumps over the lazy dog tonight ok"), (2, "nothing here"), (None, "the quick brwn fox jumps over the lazy dog tonight"), (3, None), (3, "the quick brown fox jumps over the lazy dog tonight"), (4, "")]
    df = docs_of(spark, rows)
    got = sorted(((r.doc_id, r.item_id, r.edits) for r in decontam.find(df, items).collect()), key=repr)
    assert got == sorted([(1, 1, 0), (1, 4, 0), (None, 1, 1), (None, 4, 1), (3, 1, 0), (3, 4, 0)], key=repr)
    kept = decontam.without_matches(df, items)
    assert kept.columns == df.columns and sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(2, "nothing here"), (3, None), (4, "")], key=lambda x: x[0])
    assert decontam.find(df.limit(0), items).count() == 0 and decontam.find(df, items.limit(0)).count() == 0
    assert decontam.without_matches(df, items.limit(0)).count() == len(rows)


def test_planted_passages_are_found(spark):
    d = "/root/testdata/sf0.001"
    docs, items = table(spark, d, "documents").collect(), table(spark, d, "benchmark").collect()
    got = {(r.doc_id, r.item_id) for r in queries.op3_decontamination(spark, d).collect()}
    exact = {(x.doc_id, i.item_id) for x in docs for i in items if i.text in x.text}
    assert exact <= got and len({a for a, _ in got}) <= len({a for a, _ in exact}) + 2


def plain_licenses(text):
    words = re.sub(r"[^\w]+|_", " ", (text or "").lower()).split()
    own = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    out = {}
    for name, t in licenses.TEMPLATES.items():
        tw = re.sub(r"[^\w]+|_", " ", t.lower()).split()
        want = {tuple(tw[i : i + 5]) for i in range(len(tw) - 4)}
        size = 1
        while size < len(tw) - 4:
            size *= 2
        step, long = max(1, size // 2), max(1, int(1.5 * size))
        best = max((len(want & set(own[s : s + long])) / len(want) for s in range(0, max(1, len(own)), step)), default=0)
        if best >= 0.8:
            out[name] = best
    return out


def test_licenses_equal_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    for k, t in enumerate(licenses.TEMPLATES.values()):
        words = t.split()
        rows += [(1000 + k, "Some words before it. " * k + t.upper() + " and after"), (2000 + k, " ".join(words[: len(words) // 2])), (3000 + k, " ".join(w for j, w in enumerate(words) if j != len(words) - 1))]
    rows += [(None, licenses.TEMPLATES["MIT"]), (5000, None), (5001, ""), (5002, "one"), (5003, licenses.TEMPLATES["MIT"] * 200), (5003, "x"), (5004, "a b c d e")]
    got = {}
    for r in licenses.scan(docs_of(spark, rows)).collect():
        got.setdefault(r.doc_id, {})[r.license] = r.containment
    want = {}
    for i, t in rows:
        for name, c in plain_licenses(t).items():
            mine = want.setdefault(i, {})
            mine[name] = max(c, mine.get(name, 0))
    assert got.keys() == want.keys()
    for i in want:
        assert got[i] == pytest.approx(want[i]), i
    assert licenses.scan(docs_of(spark, [])).count() == 0


def plain_nearest(model, text, k, skip=-1):
    t, w = model.vector(model.vocabulary.counts(text))
    dense = np.zeros(len(model.vocabulary.terms))
    dense[t] = w
    return dense


def test_block_max_index_is_exact():
    rng = np.random.default_rng(0)
    vectors = []
    for _ in range(400):
        t = np.unique(rng.integers(0, 60, rng.integers(1, 12)))
        w = rng.random(len(t)) + 0.1
        vectors.append((t, w / np.linalg.norm(w)))
    index = toxicity.BlockMaxIndex(vectors, 60)
    dense = np.zeros((400, 60))
    for k, (t, w) in enumerate(vectors):
        dense[k, t] = w
    for j, (at, cosine) in enumerate(index.search(vectors[:100], 15, np.arange(100))):
        full = dense @ dense[j]
        full[j] = -1
        want = [k for k in np.lexsort((np.arange(400), -np.round(full, 12)))[:15] if full[k] > 1e-12]
        assert np.allclose(cosine, full[want]) and np.allclose(np.sort(full[at]), np.sort(full[want]))
    [(at, cosine)] = index.search([(np.zeros(0, np.int64), np.zeros(0))], 5)
    assert len(at) == 0


def test_isotonic():
    x, y = toxicity.isotonic(np.array([0.1, 0.2, 0.3, 0.4, 0.4]), np.array([0.0, 1.0, 0.0, 1.0, 1.0]), np.ones(5))
    assert list(np.interp([0.1, 0.25, 0.4], x, y)) == [0.0, 0.5, 1.0]


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.1"
    got = queries.op2_toxicity(spark, d).join(table(spark, d, "labels").select("doc_id", "toxic"), "doc_id").where("held_out").toPandas()
    y, s = got.toxic.to_numpy() == 1, got.score
    rank = s.rank().to_numpy()
    auc = (rank[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    p = got.predicted.to_numpy() == 1
    assert auc > 0.93 and (p & y).sum() / p.sum() > 0.9 and (p & y).sum() / y.sum() > 0.6
    assert s.between(0, 1).all()


def test_toxicity_odd_inputs(spark):
    rows = [(i, "you awful idiot fool number" if i % 3 == 0 else "a fine day at the sea") for i in range(300)] + [(None, "idiot"), (900, None), (901, ""), (5, "idiot fool")]
    df = docs_of(spark, rows)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(300)] + [(None, 1, 1), (4, 0, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(df, labels)
    got = toxicity.score(df, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    kept = toxicity.keep_below(df, model)
    assert kept.columns == df.columns and kept.count() <= len(rows)
    for few in (labels.limit(0), labels.where("toxic = 1"), labels.where("toxic = 0")):
        m = toxicity.fit(df, few)
        assert {r.score for r in toxicity.score(df, m).collect()} == {m.empty}
    assert toxicity.score(df.limit(0), model).count() == 0
    assert toxicity.score(df.limit(0), toxicity.fit(df.limit(0), labels)).count() == 0


def test_quality_against_labels(spark):
    d = "/root/testdata/sf0.1"
    got = queries.op9_quality(spark, d).join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id").toPandas()
    y, rank = got.quality.to_numpy() == 1, got.score.rank().to_numpy()
    auc = (rank[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())
    assert auc > 0.95 and (got.keep[y] == 1).mean() > 0.95 and (got.keep[~y] == 0).mean() > 0.8


def patterns(bad, silent=None):
    said = np.where(bad, quality.BAD, quality.GOOD)
    if silent is not None:
        said = np.where(silent, quality.NONE, said)
    return Counter((said * 3 ** np.arange(quality.N_LABELLERS)).sum(axis=1).tolist()), said


def test_label_model_finds_known_accuracies():
    """Independent labellers with known accuracies and silences; and the same where three of them are one."""
    rng = np.random.default_rng(1)
    n, m = 30_000, quality.N_LABELLERS
    truth = rng.random(n) < 0.7
    sees, errs, rest = rng.uniform(0.5, 0.95, m), rng.uniform(0.01, 0.15, m), rng.uniform(0, 0.5, m)
    bad, silent = rng.random((n, m)) < np.where(truth[:, None], errs, sees), rng.random((n, m)) < rest
    for copies in ([], [1, 2]):
        bad[:, copies], silent[:, copies] = bad[:, :1], silent[:, :1]
        counts, said = patterns(bad, silent)
        post, accuracy = quality.label_model(counts)
        assert np.abs(accuracy[3:, 0] - sees[3:]).max() < 0.02 and np.abs(accuracy[3:, 1] - (1 - errs[3:])).max() < 0.01
        p = np.array([post[quality._pattern(tuple(v))] for v in said.tolist()])
        assert ((p >= 0.5) == truth).mean() > 0.985 and abs(p.mean() - truth.mean()) < 0.01


def test_label_model_keeps_kinds_of_faults_apart():
    """Two kinds of bad texts, each seen by its own two labellers, and a labeller that fires at random."""
    rng = np.random.default_rng(0)
    kind = rng.choice(3, 20000, p=[0.8, 0.12, 0.08])
    fires = rng.random((20000, quality.N_LABELLERS)) < 0.002
    for k, pair in ((1, (0, 1)), (2, (2, 3))):
        fires[:, pair] |= (kind == k)[:, None] & (rng.random((20000, 2)) < 0.9)
    fires[:, 5] |= rng.random(20000) < 0.02
    post, accuracy = quality.label_model(patterns(fires)[0])
    of = lambda *bad: post[quality._pattern(tuple(quality.BAD if k in bad else quality.GOOD for k in range(quality.N_LABELLERS)))]
    assert of() > 0.95 and of(0, 1) < 0.05 and of(2, 3) < 0.05 and of(2) < 0.3 and of(5) > 0.7
    assert accuracy[:, 1].min() > 0.97 and accuracy[0, 0] > 0.4 > accuracy[5, 0]


def plain_quality(texts):
    """The whole query without Spark: votes, posteriors, the distinct texts as examples, the scorer."""
    post, _ = quality.label_model(Counter(quality._pattern(quality.votes(t)) for t in texts))
    rows = []
    for t in {t or "" for t in texts}:
        if len(t) <= quality.EXAMPLE_CHARS:
            at, x = quality.features(t)
            rows.append((quality._pattern(quality.votes(t)), at.astype("<i2").tobytes(), x.astype("<f4")))
    rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
    count, target = len(rows), np.array([post[r[0]] for r in rows])
    dense = np.zeros((count, 1 << quality.BITS))
    for k, (_, at, x) in enumerate(rows):
        dense[k, np.frombuffer(at, "<i2")] = x
    used = np.flatnonzero(dense.any(axis=0))
    dense = dense[:, used]
    w, b, m, s = np.zeros(len(used)), 0.0, np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    weigh = target / target.sum() + (1 - target) / (1 - target).sum()
    for t in range(1, quality.STEPS + 1):
        d = weigh * (1 / (1 + np.exp(-(dense @ w + b))) - target)
        g = np.append(dense.T @ d + 1e-5 * w, d.sum() + 1e-5 * b)
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    place = {int(a): k for k, a in enumerate(used)}
    out = []
    for t in texts:
        at, x = quality.features(t)
        out.append(1 / (1 + np.exp(-(sum(w[place[a]] * v for a, v in zip(at.tolist(), x.tolist(), strict=True) if a in place) + b))))
    return out


def test_quality_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in table(spark, d, "documents").collect()}
    want = dict(zip(texts, plain_quality(list(texts.values())), strict=True))
    got = {r.doc_id: r.score for r in queries.op9_quality(spark, d).collect()}
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in want) < 1e-6


def test_quality_on_odd_inputs(spark):
    loop = "the same phrase again and " * 2_000
    rows = [(None, None), (None, None), (1, ""), (2, " \n"), (3, "word " * 200_000), (4, loop), (4, "x"), (5, loop)] + [(k, f"A plain sentence about number {k}, with several words in it. " * 6) for k in range(10, 60)]
    df = spark.createDataFrame([(i, t, 0.1, b"", 1) for i, t in rows], "doc_id long, text string, score double, h binary, pattern int")
    got = quality.score(df).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1
    assert quality.votes(loop)[7] == quality.votes(loop[:5000])[7] == quality.BAD
    assert quality.score(df.limit(0)).count() == 0


def test_repeated_texts_train_once(spark):
    """At every size of the sample the same distinct texts train, however often they repeat."""
    rows = [(k, f"Some text number {k}. It has words, and an end. " * 3 if k % 3 else f"###$$ {k} %%%&&& !!! @@@ " * 9) for k in range(90)]
    more = rows + [(1000 + k, rows[0][1]) for k in range(400)]
    for few in (20, 1000):
        a = quality.score(spark.createDataFrame(more, "doc_id long, text string"), few)
        assert {r.score > 0.5 for r in a.where("doc_id < 90 and doc_id % 3 = 0").collect()} == {False}
