"""The registered queries of the subpackage and their DuckDB twins.

Each ``opN_*`` applies its operator, with the parameters used in production, to a whole table and
derives the columns of its contract from the operator's output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linfold.llm import (chat, crosstok, langid, linededup, minhash, mixing, quality, rules, substring, suffix, tiling,
                         twins, warczip, whitening)
from linfold.llm.texts import read_table, scratch, settled
from linfold.session import fresh_name, shared_dir


def _finished(spark, make) -> DataFrame:
    """The result written once; everything that was written on the way to it is deleted."""
    kept: list[DataFrame] = []
    with scratch(spark, kept):
        kept.append(settled(make(), "result"))
    return kept[0]


def op1_quality(spark, sf_dir) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(~langid.held_out()))
    return quality.score(docs, model).select("doc_id", langid.held_out().alias("held_out"), "score", "predicted")


def op2_minhash(spark, sf_dir) -> DataFrame:
    return _finished(spark, lambda: minhash.near_duplicates(read_table(spark, sf_dir, "documents")).withColumn(
        "kept", F.col("doc_id") == F.col("component_id")))


def op3_mixing(spark, sf_dir) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).drop("_k1", "_k2")


def op4_rules(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.judge(docs).drop("text")


def op5_warc(spark, sf_dir) -> DataFrame:
    packages = warczip.write(read_table(spark, sf_dir, "pages"), shared_dir(spark, "llm", fresh_name("warc")))
    return warczip.read(spark, packages).select(
        warczip.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warczip.page_of("refers_to").alias("refers_to"))


def op6_substring(spark, sf_dir) -> DataFrame:
    return _finished(spark, lambda: substring.digests(read_table(spark, sf_dir, "documents")))


def op7_chat(spark, sf_dir) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = r"r'\### Assistant: </turn> ok'"  # a conversation that says what the template's marks say
    extra = spark.sql(f"SELECT -7L AS conv_id, turn, role, {text} AS text FROM VALUES (0L, 'user'), (1L, 'assistant') "
                      "AS t(turn, role)")
    return chat.digests(chat.read_back(chat.windows(turns.unionByName(extra))))


def op8_langid(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out()))
    return langid.predict(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op9_suffix(spark, sf_dir) -> DataFrame:
    return _finished(spark, lambda: suffix.digests(read_table(spark, sf_dir, "documents")))


def op10_tiling(spark, sf_dir) -> DataFrame:
    return tiling.tiled(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("_k1", "_k2")


def op11_whitening(spark, sf_dir) -> DataFrame:
    return _finished(spark, lambda: whitening.components(read_table(spark, sf_dir, "embeddings")))


def op12_linededup(spark, sf_dir) -> DataFrame:
    return _finished(spark, lambda: linededup.digests(read_table(spark, sf_dir, "documents")))


def op13_crosstok(spark, sf_dir) -> DataFrame:
    return _finished(spark, lambda: crosstok.aligned(read_table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_minhash": op2_minhash,
    "op3_mixing": op3_mixing,
    "op4_rules": op4_rules,
    "op5_warc": op5_warc,
    "op6_substring": op6_substring,
    "op7_chat": op7_chat,
    "op8_langid": op8_langid,
    "op9_suffix": op9_suffix,
    "op10_tiling": op10_tiling,
    "op11_whitening": op11_whitening,
    "op12_linededup": op12_linededup,
    "op13_crosstok": op13_crosstok,
}

ORACLE_SQL = dict(twins.ORACLE_SQL)
