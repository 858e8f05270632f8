"""Reports and evaluation metrics: one aggregate each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scoring as S


def counts_by(df: DataFrame, *by: str) -> DataFrame:
    """Rows of each value; values that don't occur have no row."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def counts_with_totals(df: DataFrame, *by: str) -> DataFrame:
    """Rows of each combination and of each prefix of it, down to the grand total.

    ``over`` has a bit for each column, the last one lowest, that is set where a row is the total over it: 0 for a
    combination's own row, whose nulls are nulls.
    """
    return df.rollup(*by).agg(F.grouping_id().cast("int").alias("over"), F.count(F.lit(1)).alias("n")).select(*by, "over", "n")


def score_report(scored: DataFrame, selected: DataFrame, score: str = "similarity_score") -> DataFrame:
    """Mean and maximum of all scores, minimum and maximum of the selected."""
    a = scored.agg(F.count(score).alias("n_scored"), F.round(F.avg(score), 6).alias("mean_score"), F.round(F.max(score), 6).alias("max_score"))
    b = selected.agg(F.count(F.lit(1)).alias("n_selected"), F.round(F.min(score), 6).alias("min_selected"), F.round(F.max(score), 6).alias("max_selected"))
    return a.crossJoin(b)


def length_report(df: DataFrame, length: Column) -> DataFrame:
    return df.agg(F.count(length).alias("n"), F.min(length).alias("min_chars"), F.max(length).alias("max_chars"), F.round(F.avg(length), 2).alias("avg_chars"))


def share(df: DataFrame, flag: Column, name: str = "ratio") -> DataFrame:
    """Share of rows with the flag to 4 digits; 0 for no rows."""
    return df.agg(F.coalesce(F.round(F.avg(F.coalesce(flag, F.lit(False)).cast("double")), 4), F.lit(0.0)).alias(name))


def score_responses(df: DataFrame, threshold: float = 1.0, cfg: S.Scoring = S.Scoring()) -> DataFrame:
    """All columns and format_score, format_pass, missing_sections, safety_coverage, keyword_coverage of (prompt, response, required_sections, answer_keywords, risk_level)."""
    sections = S.or_default(F.col("required_sections"), cfg.sections)
    f = S.format_score(F.col("response"), sections)
    return df.withColumns({
        "format_score": f,
        "format_pass": f >= threshold,
        "missing_sections": S.missing_sections(F.col("response"), sections),
        "safety_coverage": S.safety_coverage(F.col("prompt"), F.col("response"), F.col("risk_level"), cfg),
        "keyword_coverage": S.keyword_coverage(F.col("response"), F.col("answer_keywords")),
    })


def response_report(scored: DataFrame) -> DataFrame:
    n = F.greatest(F.count(F.lit(1)), F.lit(1))
    return scored.agg(
        F.count(F.lit(1)).alias("total"),
        (F.count_if("format_pass") / n).alias("format_accuracy"),
        F.coalesce(F.avg("format_score"), F.lit(0.0)).alias("avg_format_score"),
        F.coalesce(F.avg("safety_coverage"), F.lit(0.0)).alias("safety_coverage"),
        F.coalesce(F.avg("keyword_coverage"), F.lit(0.0)).alias("keyword_coverage"),
        F.count_if(F.expr("risk_level = 'high'")).alias("high_risk_count"),
    )


def bad_cases(scored: DataFrame) -> DataFrame:
    """Rows that fail the format, with the starts of prompt and response."""
    return scored.where("NOT format_pass").select("id", "missing_sections", F.substring("prompt", 1, 120).alias("prompt"), F.substring("response", 1, 300).alias("response"))


def perplexity(df: DataFrame, loss: Column, tokens: Column, by: list[str] | None = None) -> DataFrame:
    """(rows, tokens, nll, ppl, avg_tokens, skipped): loss weighted by tokens; infinity from 100 on; rows without tokens are skipped, a group without any has null."""
    good = loss.isNotNull() & (tokens > 0)
    n = F.sum(F.when(good, tokens))
    nll = F.sum(F.when(good, loss * tokens)) / F.nullif(n, F.lit(0).cast("long"))
    return df.groupBy(*(by or [])).agg(
        F.count_if(good).alias("rows"),
        n.cast("long").alias("tokens"),
        nll.alias("nll"),
        F.when(nll < 100, F.exp(nll)).when(nll >= 100, F.lit(float("inf"))).alias("ppl"),
        F.round(F.avg(F.when(good, tokens)), 2).alias("avg_tokens"),
        F.count_if(~F.coalesce(good, F.lit(False))).alias("skipped"),
    )


def macro_accuracy(df: DataFrame, group: str, correct: Column) -> DataFrame:
    """(group, accuracy) and, as the null group, the unweighted mean over groups."""
    each = df.where(F.col(group).isNotNull()).groupBy(F.col(group).alias("grp")).agg(F.avg(correct.cast("double")).alias("accuracy"))
    return each.unionByName(each.agg(F.lit(None).cast("string").alias("grp"), F.avg("accuracy").alias("accuracy")))


def run_diff(before: DataFrame, after: DataFrame, key: str, correct: str) -> DataFrame:
    """(outcome, n): fixed, broken, same, only_before, only_after of two runs."""
    a = before.select(key, F.col(correct).cast("boolean").alias("__a"), F.lit(1).alias("__x"))
    b = after.select(key, F.col(correct).cast("boolean").alias("__b"), F.lit(1).alias("__y"))
    o = F.when(F.col("__y").isNull(), "only_before").when(F.col("__x").isNull(), "only_after").when(~F.col("__a") & F.col("__b"), "fixed").when(F.col("__a") & ~F.col("__b"), "broken").otherwise("same")
    return a.join(b, key, "full").groupBy(o.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def group_relative(df: DataFrame, group: str, reward: str, name: str = "advantage") -> DataFrame:
    """The reward less its group's mean."""
    return df.withColumn(name, F.col(reward) - F.avg(reward).over(Window.partitionBy(group)))
