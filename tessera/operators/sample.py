"""Deterministic sampling: every order is a hash of the row's key, so results don't depend on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.jsonl import dense_ordinal


def draw(key: Column, seed: int = 42) -> Column:
    """A uniform hexadecimal string by key and seed (MD5, so that other engines can agree)."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))


def _enough(df: DataFrame, n: int, strict: bool) -> DataFrame:
    if strict and (have := df.count()) < n:
        raise ValueError(f"{have} rows, {n} wanted")
    return df


def head_sample(df: DataFrame, n: int, order: str, strict: bool = False) -> DataFrame:
    """The first n rows in order; with ``strict`` fewer are an error, found before anything is written."""
    return _enough(df.orderBy(order).limit(n), n, strict)


def hash_sample(df: DataFrame, n: int, key: str, seed: int = 42, strict: bool = False) -> DataFrame:
    """n rows without replacement, uniformly: those with the n smallest draws."""
    return _enough(df.orderBy(draw(F.col(key), seed), F.col(key)).limit(n), n, strict)


def longest(df: DataFrame, n: int, length: Column, key: str, strict: bool = False) -> DataFrame:
    """The n longest; ties by the key as a string."""
    return _enough(df.orderBy(length.desc_nulls_last(), F.col(key).cast("string")).limit(n), n, strict)


def numbered(df: DataFrame, prefix: str, order: list[Column], name: str = "id") -> DataFrame:
    """Rows (as few as a report's) renamed prefix-0, prefix-1... in order."""
    return df.withColumn(name, F.concat(F.lit(prefix + "-"), (F.row_number().over(Window.orderBy(*order)) - 1).cast("string")))


def group_limit(df: DataFrame, n: int, groups: list[str], order: str) -> DataFrame:
    """The first n rows of each group."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*groups).orderBy(order))).where(F.col("__n") <= n).drop("__n")


def stratified(df: DataFrame, n: int, high: Column, key: str, share: float = 0.30, seed: int = 42, strict: bool = True) -> DataFrame:
    """n rows: up to floor(share * n) high ones, then others, then high ones again if the others run out; fewer in all are an error if ``strict``.

    The quotas follow from two counts. Each stratum's rows are the smallest draws
    (per-partition heaps, no sort of the whole); the result is in draw order. A null
    predicate counts as not high.
    """
    flagged = df.withColumn("__high", F.coalesce(high, F.lit(False)))
    counts = flagged.agg(F.count_if("__high").alias("high"), F.count_if(F.expr("NOT __high")).alias("rest")).first()
    if strict and counts.high + counts.rest < n:
        raise ValueError(f"{counts.high + counts.rest} rows, {n} wanted")
    take_high = min(int(n * share + 1e-9), counts.high)
    take_rest = min(n - take_high, counts.rest)
    take_high = min(counts.high, n - take_rest)
    part = lambda cond, k: flagged.where(cond).orderBy(draw(F.col(key), seed), F.col(key)).limit(k)
    return part("__high", take_high).unionByName(part("NOT __high", take_rest)).drop("__high")


def hash_split(df: DataFrame, key: str, share: float, seed: int = 42, name: str = "split") -> DataFrame:
    """With a column train / val by the draw of the key: narrow, and the same on every run."""
    edge = f"{int(share * 0x10000):04x}"
    return df.withColumn(name, F.when(F.substring(draw(F.col(key), seed), 1, 4) < edge, "val").otherwise("train"))


def ordered_split(df: DataFrame, share: float, order: str, name: str = "split") -> DataFrame:
    """The first share of the rows in order is val: places by a range partitioning, so no task or driver holds the share."""
    n = int(df.count() * share)
    placed = dense_ordinal(df, [order], "__place")
    return placed.withColumn(name, F.when(F.col("__place") < n, "val").otherwise("train")).drop("__place")


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in draw order."""
    return df.orderBy(draw(F.col(key), seed), F.col(key))
