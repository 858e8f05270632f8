"""Projections between record formats."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import benchmark_reason, is_high_risk
from ..functions.text import collapse, plain, unix_lines
from ..plans.config import FORMAT_INSTRUCTION, Cases, Cleaning, Scoring
from ..sources.shared import once
from .keywords import answer_keywords

_CHAT = "array<struct<from:string,value:string>>"


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def chat(*turns: tuple[str, Column]) -> Column:
    return F.array(*(F.struct(F.lit(role).alias("from"), value.alias("value")) for role, value in turns)).cast(_CHAT)


def single_to_chat(df: DataFrame) -> DataFrame:
    """``conversations`` of (instruction, input, output): the fields that exist, joined by a blank line, and the output; rows without a prompt or an output go."""
    prompt = F.concat_ws("\n\n", _some(plain(F.col("instruction"))), _some(plain(F.col("input"))))
    out = plain(F.col("output"))
    return df.where((prompt != "") & (out != "")).select(chat(("human", prompt), ("gpt", out)).alias("conversations"))


def single_to_chat_raw(df: DataFrame) -> DataFrame:
    """The same without stripping and with empty outputs."""
    prompt = F.concat_ws("\n\n", F.coalesce("instruction", F.lit("")), _some(F.coalesce("input", F.lit(""))))
    return df.select(chat(("human", prompt), ("gpt", F.coalesce("output", F.lit("")))).alias("conversations"))


def qa_to_chat(df: DataFrame, question: str = "question", answer: str = "answer") -> DataFrame:
    return df.select(chat(("human", F.col(question)), ("gpt", F.col(answer))).alias("conversations"))


def items_to_chat(df: DataFrame, column: str = "items") -> DataFrame:
    return df.select(F.col(column).alias("conversations"))


def qa_to_messages(df: DataFrame, system: str, question: str = "question", answer: str = "answer") -> DataFrame:
    turn = lambda role, v: F.struct(F.lit(role).alias("role"), v.alias("content"))
    return df.select(F.array(turn("system", F.lit(system)), turn("user", F.col(question))).alias("prompt"), F.col(answer).alias("answer"))


def source_record(df: DataFrame, row_id: Column, source: str, cfg: Cleaning = Cleaning()) -> DataFrame:
    """(reason, instruction, input, output, source, row_id): stripped fields, a default instruction; reason is missing_output or null. Null fields are empty."""
    out = plain(F.col("output"))
    return df.select(
        F.when(out == "", "missing_output").alias("reason"),
        F.coalesce(_some(plain(F.col("instruction"))), F.lit(cfg.default_instruction)).alias("instruction"),
        plain(F.col("input")).alias("input"),
        out.alias("output"),
        F.lit(source).alias("source"),
        row_id.cast("long").alias("row_id"),
    )


def benchmark_records(df: DataFrame, subject: Column, split: Column, row: Column, names: dict[str, str] | None = None) -> DataFrame:
    """(reason, id, source columns, options, target texts) of multiple-choice rows question, A..D, answer, explanation."""
    q = unix_lines(F.col("question"))
    options = {k: unix_lines(F.col(k)) for k in "ABCD"}
    answer = F.upper(unix_lines(F.col("answer")))
    shown = F.coalesce(F.create_map(*map(F.lit, chain(*names.items())))[subject], subject) if names else subject
    choices = F.create_map(*chain(*((F.lit(k), v) for k, v in options.items())))
    lines = F.concat_ws("\n", q, *(F.concat(F.lit(f"{k}. "), v) for k, v in options.items()))
    text = F.try_element_at(choices, answer)
    with_answer = F.concat(lines, F.lit("\n答案："), answer, F.lit(". "), text)
    return df.select(
        benchmark_reason(q, options, answer).alias("reason"),
        F.concat_ws("-", subject, split, row.cast("string")).alias("id"),
        subject.alias("subject"),
        shown.alias("subject_zh"),
        split.alias("split"),
        lines.alias("question"),
        choices.alias("options"),
        F.concat(F.lit("科目："), shown, F.lit("\n题目："), lines).alias("target_text"),
        answer.alias("answer"),
        text.alias("answer_text"),
        unix_lines(F.col("explanation")).alias("explanation"),
        with_answer.alias("question_with_answer"),
        F.concat(F.lit("科目："), shown, F.lit("\n"), with_answer).alias("target_text_with_answer"),
    )


def question_only(records: DataFrame) -> DataFrame:
    """The kept records without anything of the answer."""
    return records.where("reason IS NULL").select("id", "subject", "subject_zh", "split", "question", "options", "target_text")


def question_with_answer(records: DataFrame) -> DataFrame:
    """The kept records, their target text with the answer; same ids as ``question_only``."""
    return records.where("reason IS NULL").select("id", "subject", "subject_zh", "split", "question", "options", F.col("target_text_with_answer").alias("target_text"), "answer", "answer_text", "explanation", "question_with_answer")


def case_prompt(instruction: Column, input_: Column) -> Column:
    return F.concat_ws("\n", _some(collapse(instruction)), _some(collapse(input_)))


def complex_cases(df: DataFrame, row_id: Column, cfg: Cases = Cases(), scoring: Scoring = Scoring()) -> DataFrame:
    """Case rows of (instruction, input, output): keywords of the answer, else of the prompt; rows with neither, without a prompt or an answer go."""
    prompt, answer = case_prompt(F.col("instruction"), F.col("input")), collapse(F.col("output"))
    have = df.columns
    found = once(df, {"__p": prompt, "__a": answer}).where("__p <> '' AND __a <> ''").withColumn("__k", answer_keywords(F.col("__a"), F.col("__p"), cfg))
    # else the filter would look for keywords a second time, in further Python workers
    return (
        once(found, {"__k": F.col("__k")})
        .where("__k IS NOT NULL")
        .select(
            F.concat(F.lit("case-"), row_id.cast("string")).alias("id"),
            F.col("__p").alias("prompt"),
            F.col("__a").alias("reference_answer"),
            F.col("__k").alias("answer_keywords"),
            F.when(is_high_risk(F.col("__p"), F.col("__a"), cfg), "high").otherwise("normal").alias("risk_level"),
            F.array(*map(F.lit, scoring.sections)).alias("required_sections"),
            (F.col("source") if "source" in have else F.lit(None).cast("string")).alias("source"),
            row_id.cast("long").alias("source_row_id"),
            (F.col("similarity_score") if "similarity_score" in have else F.lit(None)).cast("double").alias("similarity_score"),
            (F.col("best_target_id") if "best_target_id" in have else F.lit(None)).cast("string").alias("best_target_id"),
        )
    )


def add_format_prompt(df: DataFrame, instruction: str = FORMAT_INSTRUCTION) -> DataFrame:
    """The prompt prefixed with the format instruction, once: rows whose flag is the boolean true are only completed. A missing prompt is an error.

    ``original_prompt``, ``format_instruction`` and ``format_prompt_enabled`` may be absent.
    """
    have = dict(df.dtypes)
    col = lambda n, t="string": F.col(n).cast(t) if n in have else F.lit(None).cast(t)
    on = F.coalesce(F.col("format_prompt_enabled"), F.lit(False)) if have.get("format_prompt_enabled") == "boolean" else F.lit(False)
    original = F.coalesce(_some(plain(col("original_prompt"))), _some(plain(F.col("prompt"))))
    original = F.coalesce(original, F.raise_error(F.lit("a row has no prompt")).cast("string"))
    others = [c for c in df.columns if c not in ("prompt", "original_prompt", "format_instruction", "format_prompt_enabled")]
    return df.select(
        *others,
        F.when(on, F.col("prompt")).otherwise(F.concat(F.lit(instruction), original)).alias("prompt"),
        original.alias("original_prompt"),
        F.when(on, F.coalesce(col("format_instruction"), F.lit(instruction))).otherwise(F.lit(instruction)).alias("format_instruction"),
        F.lit(True).alias("format_prompt_enabled"),
    )


def long_text_rows(df: DataFrame, line: Column, min_chars: int = 200) -> DataFrame:
    """Candidates of the long-text set: character lengths, and provenance by row_id, source_row_id, line number."""
    have = df.columns
    ids = [F.col(c).cast("string") for c in ("row_id", "source_row_id") if c in have] + [line.cast("string")]
    out, ins, inp = plain(F.col("output")), plain(F.col("instruction")), plain(F.col("input"))
    return df.where((out != "") & (F.concat(ins, inp) != "")).where(F.length(out) >= min_chars).select(
        F.coalesce(*([F.col("id").cast("string")] if "id" in have else []), line.cast("string")).alias("id"),
        ins.alias("instruction"),
        inp.alias("input"),
        out.alias("output"),
        (F.col("source") if "source" in have else F.lit(None)).cast("string").alias("source"),
        F.coalesce(*ids).alias("source_row_id"),
        F.length(out).alias("output_char_length"),
        F.length(F.concat(ins, inp)).alias("input_char_length"),
    )


def preference(df: DataFrame, prompt: Column, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    return df.select(prompt.alias("prompt"), F.col(chosen).alias("chosen"), F.col(rejected).alias("rejected"))


def masked(prompt_ids: Column, answer_ids: Column, most: int) -> tuple[Column, Column]:
    """(input_ids, labels): the answer whole and the prompt cut from the left to fit; an answer beyond the limit is cut and stands alone. Labels of the prompt are -100."""
    a = F.slice(answer_ids, 1, most)
    room = F.lit(most) - F.size(a)
    n = F.least(F.size(prompt_ids), room)
    # slice can't start at 0, so an empty prompt is chosen by its own branch
    p = F.when(n > 0, F.slice(prompt_ids, F.size(prompt_ids) - F.greatest(n, F.lit(1)) + 1, F.greatest(n, F.lit(1)))).otherwise(F.slice(prompt_ids, 1, 0))
    return F.concat(p, a), F.concat(F.transform(p, lambda x: F.lit(-100)), a)


def masked_turns(turns: Column, most: int, eos: int) -> tuple[Column, Column]:
    """(input_ids, labels) of an array of (source, target) token lists.

    Each turn is cut in proportion to its two sides; turns are added while the whole
    fits; a target ends with ``eos`` and only targets have labels.
    """
    def cut(t: Column) -> Column:
        s, r = F.size(t["source"]), F.size(t["target"])
        ms = F.floor(F.lit(most) * s / F.greatest(s + r, F.lit(1))).cast("int")
        mt = F.floor(F.lit(most) * r / F.greatest(s + r, F.lit(1))).cast("int")
        src = F.slice(t["source"], F.lit(1), F.least(ms, s))
        tgt = F.slice(t["target"], F.lit(1), F.least(F.greatest(mt - 1, F.lit(0)), r))
        return F.struct(F.concat(src, tgt, F.array(F.lit(eos))).alias("ids"), F.concat(F.transform(src, lambda x: F.lit(-100)), tgt, F.array(F.lit(eos))).alias("labels"))

    kind = "struct<ids:array<int>,labels:array<int>,full:boolean>"
    start = F.struct(F.array().cast("array<int>").alias("ids"), F.array().cast("array<int>").alias("labels"), F.lit(False).alias("full")).cast(kind)

    def add(s: Column, t: Column) -> Column:
        fits = ~s["full"] & (F.size(s["ids"]) + F.size(t["ids"]) <= most)
        more = F.struct(F.concat(s["ids"], t["ids"]).alias("ids"), F.concat(s["labels"], t["labels"]).alias("labels"), F.lit(False).alias("full")).cast(kind)
        stop = F.struct(s["ids"].alias("ids"), s["labels"].alias("labels"), F.lit(True).alias("full")).cast(kind)
        return F.when(fits, more).otherwise(stop)

    both = F.aggregate(F.transform(turns, cut), start, add)
    return both["ids"], both["labels"]
