"""Predicates and ordered reject reasons; each returns one Column."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.config import Cases, Cleaning
from .text import content_chars


def any_contained(text: Column, terms) -> Column:
    """Whether one of the literal terms (not null, not empty) occurs in the text."""
    out = F.lit(False)
    for t in terms:
        out = out | F.contains(text, F.lit(t))
    return out


def length_reason(question: Column, answer: Column, cfg: Cleaning = Cleaning()) -> Column:
    """empty_field, then too_short, then too_long, over characters that aren't white space; null if none applies."""
    return counts_reason(content_chars(F.coalesce(question, F.lit(""))), content_chars(F.coalesce(answer, F.lit(""))), cfg)


def counts_reason(q: Column, a: Column, cfg: Cleaning = Cleaning()) -> Column:
    """``length_reason`` by the numbers of such characters."""
    return (
        F.when((q == 0) | (a == 0), "empty_field")
        .when((q < cfg.min_question) | (a < cfg.min_answer), "too_short")
        .when((q > cfg.max_question) | (a > cfg.max_answer), "too_long")
    )


def answer_length_reason(text: Column, cfg: Cleaning = Cleaning()) -> Column:
    """``length_reason`` where there is only one text."""
    n = content_chars(F.coalesce(text, F.lit("")))
    return F.when(n == 0, "empty_field").when(n < cfg.min_answer, "too_short").when(n > cfg.max_answer, "too_long")


def has_contact(text: Column, cfg: Cleaning = Cleaning()) -> Column:
    # a pattern that begins with a repeated class is tried once a run of it, where it matches if it does anywhere in the run
    once = [re.sub(r"^(\[[^\]]+\])\+", r"(?<!\1)\1+", p) for p in cfg.contact_patterns]
    return text.rlike("(?i)" + "|".join(once))


def is_ad(text: Column, cfg: Cleaning = Cleaning()) -> Column:
    """Keyword (case-sensitive substring) or contact pattern (any case, anywhere)."""
    return any_contained(text, cfg.ad_keywords) | has_contact(text, cfg)


def benchmark_reason(question: Column, options: dict[str, Column], answer: Column) -> Column:
    """missing_question, missing_option, missing_answer, invalid_answer (after upper-casing), else null; blank counts as missing."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    no_option = F.lit(False)
    for c in options.values():
        no_option = no_option | blank(c)
    return F.when(blank(question), "missing_question").when(no_option, "missing_option").when(blank(answer), "missing_answer").when(~F.upper(F.trim(answer)).isin(*options), "invalid_answer")


def is_high_risk(prompt: Column, answer: Column, cfg: Cases = Cases()) -> Column:
    text = F.lower(F.concat_ws("\n", prompt, answer))
    return any_contained(text, [t.lower() for t in cfg.risk_terms])


def valid_chat(conversations: Column, roles=("system", "human", "gpt")) -> Column:
    """Whether every turn has a known ``from`` and a ``value``; an empty list is valid, a null one not."""
    return F.coalesce(F.forall(conversations, lambda m: m["from"].isin(*roles) & m["value"].isNotNull()), F.lit(False))


def preference_fits(prompt: Column, chosen: Column, rejected: Column, most: int) -> Column:
    """0 < length of prompt + reply <= most, for both replies."""
    n = lambda r: F.length(F.concat(F.coalesce(prompt, F.lit("")), F.coalesce(r, F.lit(""))))
    return n(chosen).between(1, most) & n(rejected).between(1, most)


def has_label(labels: Column) -> Column:
    """Whether a token is left to train on."""
    return F.coalesce(F.exists(labels, lambda x: x != -100), F.lit(False))


def junk_reason(text: Column, least_letters: float = 0.3, most_marks: int = 3) -> Column:
    """misencoded (replacement characters), garbled (few letters), truncated (ends inside of a clause), marketing (many links), else null."""
    n = F.greatest(F.length(text), F.lit(1))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]", ""))
    return (
        F.when(F.contains(text, F.lit("�")) | text.rlike("Ã[\u0080-¿]"), "misencoded")
        .when(letters / n < least_letters, "garbled")
        .when(F.regexp_count(text, F.lit("https?://|www[.]")) > most_marks, "marketing")
        .when(text.rlike("[,;:，；：]\\s*$"), "truncated")
    )
