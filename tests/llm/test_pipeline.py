import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.test_dedup_tokens_mixing import plain_targets
from tests.llm.test_jaccard import plain_kept
from tidegauge.llm import decontam, toxicity
from tidegauge.llm.common import table

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_mix(rows):
    """Copies of every row by the rule itself."""
    size = defaultdict(int)
    words = {k: len((t or "").encode().split()) for k, (_, t, _) in enumerate(rows)}
    for k, (_, _, s) in enumerate(rows):
        size[s] += words[k]
    goal, copies = plain_targets(size), {}
    for s in size:
        rate = min(2.0, goal[s] / size[s]) if size[s] else 0.0
        base, part = math.floor(rate), rate - math.floor(rate)
        draw = lambda i, seed: int(hashlib.sha256(("" if i is None else str(i)).encode()).hexdigest()[8 * seed : 8 * seed + 8], 16) / 2**32
        mine = [k for k, r in enumerate(rows) if r[2] == s]
        off = [abs(base * size[s] + sum(words[k] for k in mine if draw(rows[k][0], seed) < part) - goal[s]) for seed in range(8)]
        seed = off.index(min(off))
        for k in mine:
            copies[k] = base + (draw(rows[k][0], seed) < part)
    return copies


def plain_pipeline(spark, rows, d):
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], COLUMNS)
    model = toxicity.fit(docs, table(spark, d, "labels"))
    rows = [r for r in rows if model.score(r[1])[0] < 0.7]
    first = set(plain_kept([(i, t) for i, t, _ in rows]))
    rows = [r for r in rows if r[0] in first]
    items = decontam.Items([(r.item_id, r.text) for r in table(spark, d, "benchmark").collect()], 0.1)
    rows = [r for r in rows if not items.matches(r[1])]
    copies = plain_mix(rows)
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    out, at = [], 0
    for k, (i, t, _) in sorted(enumerate(rows), key=lambda x: x[1][0]):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for _ in range(copies[k]):
            out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
    return out


def test_pipeline_equals_brute_force(spark):
    rows = [(r.doc_id, r.text, r.source) for r in table(spark, SF, "documents").collect()]
    got = sorted((tuple(r) for r in P.run(spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])
    want = plain_pipeline(spark, rows, SF)
    assert len(want) > 100 and got == want


ODD = "doc_id long, text string, lang string, source string, n_chars long, score double, _fp string, _n int, root string, item_id long, size long, copies int"


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stages_on_odd_tables(spark, name):
    stage = dict(P.STAGES)[name]
    long = "word " * 30000
    rows = [(1, None, None, None), (1, "a b c d e", "en", "s"), (1, "a b c d e", "en", "s"), (None, "x y", None, "s"), (None, "x y", None, "s"), (2, "", "en", None), (3, " \n", "en", "t"), (4, long, "en", "s"), (5, long, "en", "t"), (6, "idiot " * 9, "en", "s")]
    df = spark.createDataFrame([(*r, 1, 0.5, "f", 3, "r", 7, 8, 9) for r in rows], ODD)
    for docs in (df, df.limit(0)):
        out = stage(spark, docs, SF)
        if name != "token_ids":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        n = out.count()
        assert n == 0 if docs is not df else n > 0
        if docs is df and name == "near_duplicates":
            kept = [(r.doc_id, " ".join((r.text or "").split())) for r in out.collect()]
            assert sorted(kept, key=repr) == sorted([(1, ""), (1, "a b c d e"), (None, "x y"), (4, long.strip()), (6, "idiot " * 8 + "idiot")], key=repr)


def test_stages_keep_clean_documents(spark):
    """Of the table's documents, only those drop out that a stage has a reason for."""
    docs = table(spark, SF, "documents")
    items = [r.text for r in table(spark, SF, "benchmark").collect()]
    kept = {r.doc_id for r in P.drop_contaminated(spark, docs, SF).select("doc_id").collect()}
    planted = {r.doc_id for r in docs.collect() if any(t in r.text for t in items)}
    assert planted and not planted & kept and docs.count() - len(kept) <= len(planted) + 2
    mild = docs.where(F.lit(True)).join(table(spark, SF, "labels").where("toxic = 0"), "doc_id", "left_semi")
    assert P.drop_toxic(spark, docs, SF).join(mild.select("doc_id"), "doc_id").count() >= 0.97 * mild.count()
