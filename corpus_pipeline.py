"""A training corpus from ``documents``: language, near-duplicates, repeated passages, leaks, mixing.

Each stage takes (spark, docs, sf_dir) and returns the rows that it keeps, with the columns of its
input (the last adds the number of each copy). ``run`` writes every stage's rows as Parquet to the
shared folder and reads them again for the next, so a stage's lineage ends where the next begins
and its decisions are made once.

Stages, and what they do to rows: ``language`` drops texts without a letter and texts of which no
learned language explains a fair share (short ones stay); ``near_duplicates`` keeps the smallest id of each group; ``passages`` cuts words that
repeated 35-word passages cover out of the text (``n_chars`` follows); ``decontamination`` drops
documents that hold a benchmark item; ``mixing`` emits each document as often as its source's
weight asks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linfold.llm import langid, minhash, mixing, substring, tiling
from linfold.llm.texts import discard, on_workers, read_table, scratch, settled

#: The stages learn models and count whole tables, which SQL cannot express.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    on_workers(spark)
    return langid.accepted(docs, langid.fit(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    on_workers(spark)
    return minhash.survivors(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    on_workers(spark)
    left = substring.cut(docs)
    if "n_chars" not in left.columns:
        return left
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tiling.clean(docs, tiling.tiled(docs, read_table(spark, sf_dir, "benchmark")))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.emitted(docs, mixing.mix(docs))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("passages", passages),
    ("decontamination", decontamination),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        done: list[DataFrame] = []
        with scratch(spark, done):
            docs = settled(stage(spark, docs, sf_dir), name)
            done.append(docs)
        if before is not None:
            discard(before)
        before = docs
    return docs
