"""Corpus cleaning end to end: decode, route, repair or extract, ordered rejection, keep-first, report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import counts_reason, is_ad
from ..functions.text import content_chars, folded, tidy
from ..operators.conversation import repair
from ..operators.dedup import chat_key, mark_repeats, pair_key
from ..sources.jsonl import decoded, field, first_of
from ..sources.shared import once
from .config import Cleaning

#: String forms of values that count as nothing when a record is routed.
_NOTHING = ("[]", "{}", "0", "0.0", "false")


def classify(scan: DataFrame, cfg: Cleaning = Cleaning()) -> DataFrame:
    """(file, ord, kind, reason, repaired, instruction, input, output, conversations) of every line that isn't blank.

    ``kind`` is single or multi (null for undecodable lines); exactly one reason, or
    null for a kept row: invalid_json, invalid_record; multi_turn_failed,
    ad_or_contact, duplicate; or empty_field, too_short, too_long, ad_or_contact,
    duplicate. Duplicates are later rows in (file, ord) of an equal key among the
    rows that nothing else rejects; chats and pairs never share a key.
    """
    d = decoded(scan, "tolerant")
    conv = F.lit(None).cast("variant")
    for name in reversed(cfg.conversation_fields):
        s = field(name)
        conv = F.when(s.isNotNull() & (s != ""), field(name, "variant")).otherwise(conv)
    d = d.withColumn("__conv", F.when(F.col("reason").isNull(), conv))
    text = F.try_variant_get("__conv", "$", "string")
    d = d.withColumn("__multi", F.coalesce(text.isNotNull() & ~text.isin(*_NOTHING), F.lit(False)))
    items = F.try_variant_get("__conv", "$", "array<variant>")
    get = lambda m, a, b: F.coalesce(F.try_variant_get(m, f"$.{a}", "string"), F.try_variant_get(m, f"$.{b}", "string"))
    turns = F.transform(items, lambda m: F.struct(get(m, "from", "role").alias("from"), get(m, "value", "content").alias("value")))
    fields = {"__i": cfg.instruction_fields, "__n": cfg.input_fields, "__o": cfg.output_fields, "__q": cfg.question_fields, "__a": cfg.answer_fields}
    d = once(d, {"__turns_in": F.when(F.col("__multi"), turns)} | {c: F.when(~F.col("__multi"), first_of(names)) for c, names in fields.items()}).drop("value", "v", "__conv")
    d = repair(d, "__turns_in", cfg).drop("__turns_in")
    d = once(d.withColumns({c: folded(F.col(c)) for c in fields}), {c: tidy(F.col(c)) for c in fields})
    given = (F.col("__i") != "") & (F.col("__o") != "")
    d = d.withColumns({
        "instruction": F.when(given, F.col("__i")).otherwise(F.lit(cfg.default_instruction)),
        "input": F.when(given, F.col("__n")).otherwise(F.col("__q")),
        "output": F.when(given, F.col("__o")).otherwise(F.col("__a")),
    })
    question = F.when(F.col("input") != "", F.col("input")).when(given & (F.col("instruction") != cfg.default_instruction), F.col("instruction")).otherwise(F.lit(""))
    seen = F.concat_ws("\n", *([F.nullif(F.col("instruction"), F.lit(cfg.default_instruction))] if not cfg.parity else []), "input", "output")
    d = once(d, {"__nq": content_chars(question), "__na": content_chars(F.col("output"))})
    chat_text = F.array_join(F.transform("messages", lambda m: m["value"]), "\n")
    d = d.withColumn(
        "reason",
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(F.col("__multi"), F.when(F.col("messages").isNull(), "multi_turn_failed").when(is_ad(chat_text, cfg), "ad_or_contact"))
        .otherwise(F.coalesce(counts_reason(F.col("__nq"), F.col("__na"), cfg), F.when(is_ad(seen, cfg), F.lit("ad_or_contact")))),
    )
    key = F.when(F.col("reason").isNull(), F.when(F.col("__multi"), F.concat(F.lit("m"), chat_key(F.col("messages")))).otherwise(F.concat(F.lit("s"), pair_key(question, F.col("output")))))
    d = d.withColumn("__key", key)
    if cfg.dedup:
        d = mark_repeats(d, F.col("__key"), [F.col("file"), F.col("ord")])
        d = d.withColumn("reason", F.when(F.col("is_repeat"), "duplicate").otherwise(F.col("reason")))
    parsed = ~F.coalesce(F.col("reason").isin("invalid_json", "invalid_record"), F.lit(False))
    kept = F.col("reason").isNull()
    return d.select(
        "file",
        "ord",
        F.when(parsed, F.when(F.col("__multi"), "multi").otherwise("single")).alias("kind"),
        "reason",
        (F.col("__multi") & F.col("changed")).alias("repaired"),
        *(F.when(kept & ~F.col("__multi"), F.col(c)).alias(c) for c in ("instruction", "input", "output")),
        F.when(kept, F.col("messages")).alias("conversations"),
    )


def kept_pairs(classified: DataFrame) -> DataFrame:
    return classified.where("reason IS NULL AND kind = 'single'").select("instruction", "input", "output")


def kept_chats(classified: DataFrame) -> DataFrame:
    return classified.where("reason IS NULL AND kind = 'multi'").select("conversations")


def report(classified: DataFrame) -> DataFrame:
    """One row: total_read, each reason, multi_turn_repaired, single_kept, multi_kept, kept, input_files. Reasons and kept rows sum to total_read."""
    reasons = ("invalid_json", "invalid_record", "multi_turn_failed", "ad_or_contact", "duplicate", "empty_field", "too_short", "too_long")
    return classified.agg(
        F.count(F.lit(1)).alias("total_read"),
        F.count_distinct("file").alias("input_files"),
        *(F.count_if(F.col("reason") == r).alias(r) for r in reasons),
        F.count_if("repaired").alias("multi_turn_repaired"),
        F.count_if(F.expr("reason IS NULL AND kind = 'single'")).alias("single_kept"),
        F.count_if(F.expr("reason IS NULL AND kind = 'multi'")).alias("multi_kept"),
        F.count_if(F.expr("reason IS NULL")).alias("kept"),
    )
