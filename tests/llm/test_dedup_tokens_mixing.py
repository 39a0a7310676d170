import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from tidegauge.llm import dac, mixing, queries, simhash
from tidegauge.llm.common import connected_components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, root int, size string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "x", 1, "y") for i, t, s in rows], DOCS)


def plain_fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hs = [xxhash.xxh64_intdigest(s, seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(rows, radius=4):
    fps = [(i, plain_fingerprint(t)) for i, t, _ in rows]
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a][1] ^ fps[b][1]).bit_count() <= radius:
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for k, (i, _) in enumerate(fps):
        groups[find(k)].append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return sorted(((i, f"{fp:016x}", least[find(k)]) for k, (i, fp) in enumerate(fps)), key=repr)


def test_masks_cover_every_pair_within_the_radius():
    for radius in (1, 2, 4):
        masks = simhash.covering_masks(radius)
        rng = np.random.default_rng(0)
        for _ in range(2000):
            x = sum(1 << int(i) for i in rng.choice(64, radius, replace=False))
            assert any(x & m == 0 for m in masks)
        assert all(16 < m.bit_count() < 48 for m in masks)


def test_near_duplicates_equal_brute_force(spark):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(900, None, None), (901, "", "a"), (902, " \t\n", "a"), (903, "one two", None), (904, "ONE  two", "b"), (None, "one two", "b"), (903, "one two", None)]
    got = simhash.near_duplicates(docs_of(spark, rows)).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("f"), "component_id")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_components(rows)


def test_dense_group_in_blocks(spark, monkeypatch):
    """Chains and dense balls that fill many blocks keep every link."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 2**63, 3)]
    fps = {b ^ sum(1 << int(i) for i in rng.choice(24, int(rng.integers(0, 6)), replace=False)) for b in base for _ in range(120)}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = dict((r.node, r.root) for r in simhash.components(df, 4).collect())
    fps, root = sorted(fps), {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 4 and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert all(got.get(f, f) == find(f) for f in fps)


def test_components_of_chains(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001), (1001, 1001)], "src long, dst long")
    got = dict((r.node, r.root) for r in connected_components(edges).collect())
    assert got == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}


def test_empty_tables(spark):
    none = docs_of(spark, [])
    assert simhash.near_duplicates(none).count() == 0
    assert dac.read_back(dac.write(none, public_tokenizers.path(queries.TOKENIZER))).count() == 0
    assert mixing.decide(none).count() == 0 and mixing.mix(none).count() == 0


def test_codes_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    ids = [rng.integers(0, top, n).astype("<u4") for top, n in ((50000, 5000), (256, 3), (2**32, 700), (10, 0), (70000, 1))]
    f = dac.Reader(dac.dump([3, None, 5, 6, 7], ids))
    whole = np.concatenate(ids)
    assert [list(f.document(k)) for k in range(5)] == [list(x) for x in ids]
    assert [f.token(i) for i in range(len(whole))] == list(whole)
    for a, b in ((0, 0), (17, 900), (4999, 5003), (511, 512), (512, 1025)):
        assert list(f.slice(a, b)) == list(whole[a:b])
    assert list(f.valid) == [1, 0, 1, 1, 1]


ODD = [
    "", " ", "a", " a", "a ", "a  b", "a\nb", "a \nb", "a\n\nb", "a\tb", "a b c", "it's we'll. ok!?", "x" * 500 + " y", "ä ö, ü.", "日本 語。",
    "1,000.5 a.b. c", "<|endoftext|> a", "a <|endoftext|>b", "é   z", "don't,  stop", "a,.", "I. \nYou; me:", "!. ?,", "𝒳 👩‍👩‍👧 .", "\x00 a\x00", "²³ ½.",
]


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.TOKENIZER)
    enc, tok = dac.Encoder(path), Tokenizer.from_file(path)
    for t in ODD + [" ".join(ODD), "\n".join(ODD)]:
        assert list(np.frombuffer(enc.text(t), "<u4")) == tok.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("file_tokens", [50, 1 << 22])
def test_token_files_equal_plain_encoding(spark, file_tokens):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.TOKENIZER)
    tok = Tokenizer.from_file(path)
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    rows += [(1000 + k, t, "s") for k, t in enumerate(ODD)] + [(None, "x", "s"), (7000, None, "s"), (1000, "b", "s")]
    got = [tuple(r) for r in dac.read_back(dac.write(docs_of(spark, rows), path, file_tokens=file_tokens)).collect()]
    want, at = [], 0
    for i, t, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, free, goal = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        t = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if t[s] > 2 * sizes[s]}
        if not over:
            return goal | t
        goal |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2.0 * sizes[s] for s in over)
        free -= over
    return goal


def test_mixing_targets_and_totals(spark):
    rng = np.random.default_rng(5)
    names = ["a", "B", "é", None, "zz", "empty"]
    rows = [(k, "w " * int(rng.integers(1, 90)), names[int(rng.integers(0, 5))]) for k in range(3000)] + [(9000, " ", "empty"), (9001, None, "empty"), (None, "x\x0by", "a")]
    df = docs_of(spark, rows)
    got = mixing.decide(df).collect()
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len((t or "").encode().split())
    goal = plain_targets(size)
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - goal[r.source]) < 1e-6 * max(1, goal[r.source])
        assert r.copies * r.size <= 2 * r.size
        taken[r.source] += r.copies * r.size
    for s in size:
        assert abs(taken[s] - goal[s]) <= 0.02 * max(goal[s], 1), (s, taken[s], goal[s])
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.decide(df.repartition(5)).collect()), key=repr)
    copies = defaultdict(int)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    for r in mixed.collect():
        copies[r.doc_id] += 1
    assert copies == {r.doc_id: r.copies for r in got if r.copies}
