"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tidegauge.llm import ann, chat, dac, decontam, licenses, mixing, quality, simhash, suffix, toxicity
from tidegauge.llm.common import table

TOKENIZER = "byte_bpe_50k.json"


def op1_simhash(spark, d):
    found = simhash.near_duplicates(table(spark, d, "documents"), radius=4, width=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_toxicity(spark, d):
    docs = table(spark, d, "documents")
    found = toxicity.score(docs, toxicity.train(docs, table(spark, d, "labels")))
    predicted = (F.col("score") >= toxicity.THRESHOLD).cast("int")
    return found.select("doc_id", toxicity.held_out().alias("held_out"), "score", predicted.alias("predicted"), "neighbours", "cosines")


def op3_decontamination(spark, d):
    return decontam.find(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op4_token_ids(spark, d):
    return dac.read_back(dac.write(table(spark, d, "documents"), public_tokenizers.path(TOKENIZER)))


def op5_mixing(spark, d):
    found = mixing.decide(table(spark, d, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op6_nearest(spark, d):
    return ann.search(table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op7_suffix_array(spark, d):
    return suffix.deduplicate(table(spark, d, "documents"))


def op8_licenses(spark, d):
    return licenses.scan(table(spark, d, "documents"))


def op9_quality(spark, d):
    return quality.score(table(spark, d, "documents")).withColumn("keep", (F.col("score") >= 0.5).cast("int"))


def op10_chat(spark, d):
    odd = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    return chat.digests(table(spark, d, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_token_ids": op4_token_ids,
    "op5_mixing": op5_mixing,
    "op6_nearest": op6_nearest,
    "op7_suffix_array": op7_suffix_array,
    "op8_licenses": op8_licenses,
    "op9_quality": op9_quality,
    "op10_chat": op10_chat,
}

def _escaped(c: str) -> str:
    """Code points of an escaped text in SQL: one more for each backslash and each control string."""
    more = [f"(length({c}) - length(replace({c}, '{x}', ''))) // {len(x)}" for x in ("\\", *chat.CONTROL)]
    return f"(length({c}) + {' + '.join(more)})"


_TURNS = "order by turn nulls first, role, text"
_CHAT = f"""with c as (
  select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text from conversations
  union all select -7, t, r, '\\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) v(t, r))
select conv_id, cast(count(*) as bigint) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' {_TURNS})) turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) loss_chars,
  sha256(coalesce(string_agg(text, '' {_TURNS}) filter (where role = 'assistant'), '')) loss_sha256,
  cast(sum(length('<turn>### : </turn>') + 1 + {_escaped('role')} + {_escaped('text')}) as bigint) formatted_chars
from c group by conv_id"""
ORACLE_SQL = {"op5_mixing": mixing.ORACLE, "op7_suffix_array": suffix.ORACLE, "op8_licenses": licenses.oracle(), "op10_chat": _CHAT}
