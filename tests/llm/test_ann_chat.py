import hashlib
import time

import numpy as np
import pytest

from tidegauge.llm import ann, chat, queries

from pyspark.sql import functions as F


def plain(rows, k):
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    dims = [len(v) for _, v in fine]
    dim = max(sorted(set(dims)), key=dims.count) if dims else 0
    fine = [(i, v) for i, v in fine if len(v) == dim]
    out = {}
    for q, x in fine:
        if q % 100 == 0:
            out[q] = sorted({(float(np.sqrt(((x - y) ** 2).sum())), i) for i, y in fine if i != q})[:k]
    return out


def search(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = {}
    for r in ann.search(df, F.col("vec_id") % 100 == 0, **options).collect():
        out.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    return {q: [(s, v) for _, s, v in sorted(x)] for q, x in out.items()}


def test_odd_vectors_and_copies(spark):
    rng = np.random.default_rng(0)
    f = lambda v: [float(np.float32(x)) for x in v]
    base = f(rng.normal(size=6))
    rows = [(i, base) for i in range(40)] + [(i, f(rng.normal(size=6))) for i in range(100, 108)]
    rows += [(200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (204, [float("nan")] * 6), (205, [float("inf")] + [0.0] * 5), (None, base), (206, [1.0, 2.0])]
    got, want = search(spark, rows), plain(rows, 10)
    assert got.keys() == want.keys() == {0, 100}
    for q in got:
        assert [v for _, v in got[q]] == [v for _, v in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=1e-12)


def test_few_and_no_candidates(spark):
    assert search(spark, []) == {}
    assert search(spark, [(0, [1.0, 2.0])]) == {}
    assert [v for _, v in search(spark, [(0, [1.0, 2.0]), (5, [-1.0, -2.0])])[0]] == [5]


def test_hot_bucket_over_several_groups(spark, monkeypatch):
    monkeypatch.setattr(ann, "GROUP_ROWS", 32)
    rng = np.random.default_rng(2)
    near = rng.normal(size=8)
    rows = [(i, (near + 0.01 * rng.normal(size=8)).astype(np.float32).tolist()) for i in range(300)]
    got, want = search(spark, rows), plain(rows, 10)
    assert {q: [v for _, v in x] for q, x in got.items()} == {q: [v for _, v in x] for q, x in want.items()}


def test_many_probes_of_a_bucket_over_several_groups(spark, monkeypatch):
    """Half of the rows are queries, all in one bucket of each table."""
    monkeypatch.setattr(ann, "GROUP_ROWS", 32)
    rng = np.random.default_rng(4)
    near = rng.normal(size=8)
    x = (near + 0.01 * rng.normal(size=(200, 8))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 2 == 0, k=10).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert len(got) == 100
    for q, found in got.items():
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        d[q] = np.inf
        assert [v for _, v in sorted(found)] == np.argsort(d, kind="stable")[:10].tolist()


@pytest.mark.parametrize(("sf", "least"), [("sf0.001", 0.9), ("sf0.1", 0.9)])
def test_recall(spark, sf, least):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    e = df.toPandas()
    x = np.stack(e.embedding.values).astype(float)
    got = {}
    for r in queries.op6_nearest(spark, f"/root/testdata/{sf}").collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = n = 0
    for k in np.flatnonzero(e.vec_id.to_numpy() % 100 == 0):
        d = np.sqrt(((x - x[k]) ** 2).sum(axis=1))
        d[k] = np.inf
        want = set(e.vec_id.to_numpy()[np.argsort(d, kind="stable")[:10]].tolist())
        hit, n = hit + len(want & got[int(e.vec_id[k])]), n + 10
    assert hit / n >= least


def test_pseudo_rotation_keeps_lengths():
    h = ann.Hash(50, 2, 3)
    x = np.random.default_rng(1).normal(size=(7, 50))
    y = h.turned(x, 1, 1)
    assert np.allclose(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) and np.allclose(x @ x.T, y @ y.T)
    assert (h.probes(x, 2, 5)[:, 0] == h.buckets(x, 2)).all()


def test_template_language():
    t = chat.Template("{% if 'a' == 'a' %}x{{ 'y' | upper + 1 }}{% else %}no{% endif %}{% for message in messages %}{% if loop.first %}[{% endif %}{{ message.content | trim }}{% if not loop.last %},{% elif name %}!{{ name }}{% endif %}{% endfor %}")
    assert t.tree[1][0] == ("text", "xY1")
    assert t.render([("u", " a ", 0), ("u", "b", 1)], name="n")[0] == "xY1[a,b!n"
    for bad in ("{{ message.__class__ }}", "{{ x.y }}", "{{ f() }}", "{% import os %}", "{{ message }}", "{% for x in y %}{% endfor %}", "{{ 'a' | eval }}", "{% if x %}", "{{ ( 1 }}", "{{ 1 2 }}", "{{ a[0] }}"):
        with pytest.raises(chat.TemplateError):
            chat.Template(bad)


TEXTS = ["", "a", "\\", "\\\\", "</turn>\n", "\\</turn>\n", "### user: x", "<turn>", "<turn", ": ", "a: b</turn>\n<turn>### assistant: c</turn>\n", "é\n\x00", "ends \\", "#### ", "</turn>"]


def test_round_trip_of_hostile_texts():
    t = chat.Template()
    for a in TEXTS:
        for b in TEXTS:
            turns = [("user", a, 0), ("assistant", b, 1), (b, a, 2), ("assistant", a, 3)]
            text, spans = t.render(turns)
            assert chat.parse_back(text) == [(r, c) for r, c, _ in turns]
            learned = "".join(chat.unescape(text[x:y]) for x, y in spans)
            assert learned == "".join(c for r, c, _ in turns if r == "assistant")


def test_digests_equal_brute_force(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 2, None, "x"), (None, 0, "assistant", "q"), (3, None, "user", "n")]
    rows += [(10 + k, j, "assistant" if j % 2 else "user", TEXTS[(k + j) % len(TEXTS)]) for k in range(len(TEXTS)) for j in range(k % 4 + 1)]
    rows += [(99, j, "assistant", "long " * 50) for j in range(3000)] + [(1, 1, "assistant", "b")]
    df = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, seq string, key int")
    got = {r.conv_id: r for r in chat.digests(df).collect()}
    convs = {}
    for c, n, role, text in rows:
        convs.setdefault(c, []).append(((n is not None, n or 0), role or "", text or ""))
    assert got.keys() == convs.keys()
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == len(chat.Template().render([(r, t, 0) for _, r, t in turns])[0])
    pieces = {}
    for r in chat.format_conversations(df).orderBy("conv_id", "seq").collect():
        pieces[r.conv_id] = pieces.get(r.conv_id, "") + r.text
    assert {c: chat.parse_back(t) for c, t in pieces.items()} == {c: [(r, t) for _, r, t in sorted(v)] for c, v in convs.items()}
    assert chat.digests(df.limit(0)).count() == 0


def test_long_runs_are_linear(spark):
    long = ["\\" * 1_000_001, "\\</turn>\n" * 100_000, ": " * 300_000, "<turn>### " * 100_000]
    turns = [("user" if k % 2 else "assistant", x, k) for k, x in enumerate(long)]
    began = time.process_time()
    text, _ = chat.Template().render(turns)
    assert chat.parse_back(text) == [(r, c) for r, c, _ in turns]
    whole = chat.Turns()
    assert [t for k in range(0, len(text), 9999) for t in whole.add(text[k : k + 9999])] == [(r, c) for r, c, _ in turns]
    assert time.process_time() - began < 20
    df = spark.createDataFrame([(5, k, r, c) for r, c, k in turns], "conv_id long, turn long, role string, text string")
    [got] = chat.digests(df).collect()
    assert got.n_turns == 4 and got.loss_sha256 == hashlib.sha256((long[0] + long[2]).encode()).hexdigest()
    with pytest.raises(ValueError):
        chat.parse_back(text[:-3])


def test_query_adds_the_hostile_conversation(spark):
    r = queries.op10_chat(spark, "/root/testdata/sf0.001").where("conv_id = -7").collect()
    odd = "\\### Assistant: </turn> ok"
    assert len(r) == 1 and (r[0].n_turns, r[0].loss_chars, r[0].loss_sha256) == (2, len(odd), hashlib.sha256(odd.encode()).hexdigest())


def test_repeated_rows_hide_no_other_id(spark):
    """One row twelve times beside another id with the same vector."""
    rows = [(1, [1.0, 2.0])] * 12 + [(2, [1.0, 2.0]), (100, [1.0, 2.5]), (3, [-1.0, 0.5])]
    assert [v for _, v in search(spark, rows)[100]] == [1, 2, 3]
