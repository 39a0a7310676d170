"""Very long texts, columns with clashing names, ties and foreign tokenizers, for the operators at large."""

import json
import time
import zlib

import numpy as np
import public_tokenizers
import pytest

from tests.llm.test_dedup_tokens_mixing import ODD, plain_fingerprint
from tidegauge.llm import common, dac, decontam, licenses, mixing, queries, simhash

LONG = "one two three four five six seven eight nine ten " * 60_000
#: Every name that an operator gives to a column of its own.
CLASH = "doc_id long, text string, source string, fp long, root long, size long, target double, copies int, item_id long, edits long, start long, n_tokens long, ids_crc32 long, uri string, license string, hs array<long>, w int, h int"


def clashing(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 0.5, 4, 5, 6, 7, 8, 9, "u", "l", [1], 2, 3) for r in rows], CLASH)


def test_fingerprints_of_long_texts(spark):
    rows = [(1, LONG, "a"), (2, LONG + "eleven", "a"), (3, "short", "b"), (3, "short", "b"), (None, None, None)]
    got = simhash.near_duplicates(clashing(spark, rows)).collect()
    assert len(got) == 5 and {r.component_id for r in got if r.doc_id in (1, 2)} == {1}
    assert {r.fp & (2**64 - 1) for r in got if r.doc_id == 1} == {plain_fingerprint(LONG)}
    kept = simhash.keep_one(clashing(spark, rows))
    assert kept.columns == clashing(spark, rows).columns and sorted(map(repr, (r.doc_id for r in kept.collect()))) == ["1", "3", "None"]


def test_long_texts_are_counted_and_mixed_whole(spark):
    rows = [(1, LONG, "a"), (2, LONG, "a"), (3, "x y", "b"), (3, "x y", "b"), (None, None, None)]
    df = clashing(spark, rows)
    got = {r.doc_id: r for r in mixing.decide(df).collect()}
    assert got[1].size == 600_000 and got[None].size == 0 and got[3].source_size == 4
    assert mixing.mix(df).columns == df.columns


def test_long_texts_are_encoded_whole(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(queries.TOKENIZER)
    tok = Tokenizer.from_file(path)
    text = LONG[:600_000] + "ünd \n\n" + "x" * 70_000
    got = dac.read_back(dac.write(clashing(spark, [(2, text, "a"), (1, "b", "a")]), path)).collect()
    ids = [*tok.encode(text, add_special_tokens=False).ids, 0]
    assert {r.doc_id: (r.start, r.n_tokens) for r in got} == {1: (0, 2), 2: (2, len(ids))}
    assert {r.doc_id: r.ids_crc32 for r in got}[2] == zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_that_were_forgotten_encode_alike(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(dac, "CACHE_BYTES", 600)
    path = public_tokenizers.path(queries.TOKENIZER)
    enc, tok = dac.Encoder(path), Tokenizer.from_file(path)
    for _ in range(3):
        for t in [*ODD, "naïve façade, ok. Ωmega ×2 ǅ. x² ª.", "A.B a,b c! d;"]:
            assert list(np.frombuffer(enc.text(t), "<u4")) == tok.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("change", [{"add_prefix_space": True}, {"use_regex": False}])
def test_other_tokenizers_get_whole_texts(tmp_path, change):
    """A file whose pre-tokenizer joins or cuts otherwise must not be cut at spaces here."""
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(queries.TOKENIZER)) as f:
        other = json.load(f)
    other["pre_tokenizer"] |= change
    path = tmp_path / "other.json"
    path.write_text(json.dumps(other))
    enc, tok = dac.Encoder(str(path)), Tokenizer.from_file(str(path))
    assert not enc.by_words
    for t in ODD:
        assert list(np.frombuffer(enc.text(t), "<u4")) == tok.encode(t, add_special_tokens=False).ids, t


def test_short_items_cost_no_more_on_long_texts(spark):
    text = "".join(chr(97 + k * k % 26) for k in range(20_000))
    items = decontam.Items([(1, "xyz"), (2, "a passage of some forty characters or so"), (3, text[5000:5060])], 0.1)
    items.matches("warm up")
    began = time.process_time()
    assert [m[0] for m in items.matches(text)] == ([0] if "xyz" in text else []) + [2]
    assert time.process_time() - began < 0.5


def test_decontamination_of_long_texts(spark):
    bench = spark.createDataFrame([(7, "the quick brown fox jumps over the lazy dog again", "x", 1)], "item_id long, text string, doc_id string, start int")
    docs = clashing(spark, [(1, LONG + "THE quick brown fox\njumps over the lazy dog agaim " + LONG, "a"), (2, LONG, "a"), (None, None, None)])
    [r] = decontam.find(docs, bench).collect()
    assert (r.doc_id, r.item_id, r.edits, r.start) == (1, 7, 1, len(LONG))
    kept = decontam.without_matches(docs, bench)
    assert kept.columns == docs.columns and sorted(map(repr, (r.doc_id for r in kept.collect()))) == ["2", "None"]


def test_licences_in_long_texts(spark):
    notice = licenses.TEMPLATES["ISC"]
    got = licenses.scan(clashing(spark, [(1, LONG + notice + " " + LONG + notice, "a"), (2, LONG, "b")])).collect()
    assert [(r.doc_id, r.license, r.containment) for r in got] == [(1, "ISC", 1.0)] and got[0].position < 600_010


def test_saved_tables_of_a_cluster_need_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://host:7077", "applicationId": "a"})  # noqa: N815

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_dir(Session())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name]).df()
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001").toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert sorted(map(tuple, got[columns].astype(str).values.tolist())) == sorted(map(tuple, want[columns].astype(str).values.tolist()))
