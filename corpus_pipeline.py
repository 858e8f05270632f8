"""A training-data pipeline: language ID, near-dedup, decontamination, mixing, tokens.

Every stage takes (spark, docs, sf_dir), works on all that the one before kept
and is written as Parquet before the next one reads it. Columns beyond those named
are carried by all stages but the last; an empty table gives empty tables; texts are
never cut, however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bagminhash, contamination, language, mixing, token_orc
from tessera.llm.common import remove, scratch, table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text no language explains go.

    Null and empty texts and those without letters go, as does all if no row has a ``lang``; a row with a null doc_id is judged by its text like
    any other; repeated rows are judged alike.
    """
    return language.accepted(docs, language.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest doc_id.

    Repeated rows of one doc_id stay or go together; rows with a null doc_id, null texts and texts without
    words stay; of a doc_id with several texts one is compared, the other rows stay.
    """
    return bagminhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go, in scripts without spaces too.

    Every row is judged by its own text; null and short texts stay, as does all with an empty benchmark.
    """
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"), scripts=True)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken as often as their rates say; the targets are shares of the BPE tokens that the next stage writes.

    So copies can occur and documents can be missing. Null and empty texts are taken once; repeated rows of a doc_id are
    taken equally often, rows without an id each by a draw of their own; without any labels all are taken once.
    """
    return mixing.mixed(docs, table(spark, sf_dir, "labels"), count="bpe_tokens")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, tokens) of every row, as read from the ORC table; a null text has null tokens, an empty one none."""
    return token_orc.token_table(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("tokenize", tokenize)]

#: Signatures, classifiers and BPE are not SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage writes besides its result is deleted after it, its result once the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with scratch(spark) as keep:
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}", keep)
        if before:
            remove(spark, before)
        before = keep[0]
    return docs
