"""Exact keys and keep-first removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import compact


def pair_key(question: Column, answer: Column) -> Column:
    """SHA-256 of both texts, lower-cased and without white space."""
    return F.sha2(F.concat_ws("\n", compact(F.coalesce(question, F.lit(""))), compact(F.coalesce(answer, F.lit("")))), 256)


def chat_key(messages: Column) -> Column:
    """SHA-256 of the lines role:text."""
    return F.sha2(F.array_join(F.transform(messages, lambda m: F.concat(m["from"], F.lit(":"), compact(F.coalesce(m["value"], F.lit(""))))), "\n"), 256)


def mark_repeats(df: DataFrame, key: Column, order: list[Column], name: str = "is_repeat") -> DataFrame:
    """Whether an earlier row has the same key; null keys never repeat. One shuffle, on the key (rows without one are spread by their order columns)."""
    spread = F.when(key.isNull(), F.xxhash64(*order))
    return df.withColumn(name, key.isNotNull() & (F.row_number().over(Window.partitionBy(key, spread).orderBy(*order)) > 1))


def keep_first(df: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """The first row of each key by the order; rows with a null key stay."""
    return mark_repeats(df, key, order, "__again").where("NOT __again").drop("__again")


def best_answer(df: DataFrame, question: Column, score: Column, tie: Column) -> DataFrame:
    """Of the rows with one question (compared as by ``compact``) that with the highest score, then the smallest tie."""
    by = Window.partitionBy(compact(F.coalesce(question, F.lit("")))).orderBy(score.desc_nulls_last(), tie)
    return df.withColumn("__nth", F.row_number().over(by)).where("__nth = 1").drop("__nth")
