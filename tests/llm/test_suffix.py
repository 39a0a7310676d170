import hashlib
import random

import numpy as np
import pytest

from tidegauge.llm import suffix

SCHEMA = "doc_id long, text string, source string, part int, uri string, bucket int"


def plain(rows, n=50):
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in texts:
        if i is not None:
            for p in range(len(b) - n + 1):
                s = b[p : p + n]
                first[s] = min(first.get(s, i), i)
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        if i is not None:
            for p in range(len(b) - n + 1):
                if first[b[p : p + n]] < i:
                    gone[p : p + n] = b"\1" * n
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "s", 1, "u", 2) for i, t in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in suffix.deduplicate(df, **options).collect()), key=repr)


def made(seed, n):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdeä \n") for _ in range(rng.randint(45, 160))) for _ in range(6)]
    rows = []
    for i in range(n):
        bits = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            bits += [p[a : rng.randint(a, len(p))] if rng.random() < 0.6 else p, "".join(rng.choice("xyz é") for _ in range(rng.randint(0, 70)))]
        rows.append((i, "".join(bits)))
    return rows + [(n, "a" * 400), (n + 1, "a" * 60), (n + 2, "ab" * 100), (n + 3, "\x00" * 120), (n + 4, "\x00" * 55), (n + 5, "q" * 49), (n + 6, "q" * 50), (n + 7, "q" * 49)]


@pytest.mark.parametrize(("seed", "hot"), [(1, 2048), (2, 1), (3, 2048)])
def test_equals_brute_force(spark, monkeypatch, seed, hot):
    rows = made(seed, 60)
    rows += [(None, rows[3][1]), (None, "q" * 60), (7, rows[7][1]), (7, rows[9][1]), (100, None), (101, ""), (3, rows[20][1]), (500, rows[7][1]), (500, rows[7][1])]
    assert run(spark, rows, hot=hot) == plain(rows)


def test_documents_of_the_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert run(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_merge_never_looks_at_known_prefixes():
    """The merged order and prefixes are right, and runs come back from their front coding."""
    rng = np.random.default_rng(0)
    runs, rows = [], []
    for k in range(7):
        m = rng.integers(0, 2, (k * 9, suffix.RECORD)).astype(np.uint8)
        m = m[np.lexsort(m[:, : suffix.LENGTH].T[::-1])] if len(m) else m
        m[:, 8 : suffix.LENGTH] = 0
        m = m[np.lexsort(m[:, : suffix.LENGTH].T[::-1])] if len(m) else m
        runs.append(suffix.Run(suffix.encode_run(m, np.arange(len(m)))))
        assert [s for s, _ in runs[-1]] == [bytes(x[: suffix.LENGTH]) for x in m]
        rows += [bytes(x[: suffix.LENGTH]) for x in m]
    order, lcp = suffix.merge(runs)
    its = [iter(r) for r in runs]
    merged = [next(its[k])[0] for k in order]
    assert merged == sorted(rows)
    for a, b, c in zip(merged, merged[1:], lcp[1:], strict=False):
        want = next((i for i in range(suffix.LENGTH) if a[i] != b[i]), suffix.LENGTH)
        assert c == want
