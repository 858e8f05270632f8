"""Rule-based response scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.config import Scoring
from .rules import any_contained
from .text import collapse


def _array(words: Column | tuple | list) -> Column:
    return words if isinstance(words, Column) else F.array(*map(F.lit, words)).cast("array<string>")


def or_default(sections: Column | tuple | list, default: tuple = Scoring.sections) -> Column:
    """The section names, or the default ones where a row has none (null or an empty array)."""
    s = _array(sections)
    return F.when(F.coalesce(F.size(s), F.lit(0)) > 0, s).otherwise(_array(default))


def missing_sections(response: Column, sections: Column | tuple = Scoring.sections) -> Column:
    """Section names that the response lacks; a blank name is never missing. A row without names is held to the default ones."""
    r = collapse(response)
    return F.filter(or_default(sections), lambda s: ~F.contains(r, collapse(s)))


def format_score(response: Column, sections: Column | tuple = Scoring.sections) -> Column:
    """Share of the sections that occur; a blank name is a hit. A row without names is held to the default ones."""
    s = or_default(sections)
    return (F.size(s) - F.size(missing_sections(response, s))) / F.greatest(F.size(s), F.lit(1))


def format_reward(response: Column, sections: Column | tuple = Scoring.sections) -> Column:
    """As ``format_score``, but a blank name is no hit and an empty response has 0."""
    r, s = collapse(response), or_default(sections)
    hits = F.size(F.filter(s, lambda x: (collapse(x) != "") & F.contains(r, collapse(x))))
    return F.when(r == "", 0.0).otherwise(hits / F.greatest(F.size(s), F.lit(1)))


def keyword_coverage(response: Column, keywords: Column | tuple) -> Column:
    """Share of the keywords that aren't blank and occur in the response, in any case; 0 without keywords."""
    r = F.lower(collapse(response))
    k = F.filter(F.transform(F.coalesce(_array(keywords), F.array().cast("array<string>")), lambda x: F.lower(collapse(x))), lambda x: x != "")
    return F.when(F.size(k) == 0, 0.0).otherwise(F.size(F.filter(k, lambda x: F.contains(r, x))) / F.size(k))


def safety_coverage(prompt: Column, response: Column, risk: Column, cfg: Scoring = Scoring()) -> Column:
    """0 with a negative term; for a high risk 1 needs a positive one; else 1."""
    p, r = collapse(prompt), collapse(response)
    high = (risk == "high") | any_contained(p, cfg.prompt_risk)
    return F.when(any_contained(r, cfg.negative), 0.0).when(high & ~any_contained(r, cfg.positive), 0.0).otherwise(1.0)


def safety_reward(prompt: Column, response: Column, risk: Column, cfg: Scoring = Scoring()) -> Column:
    """Graded: a quarter off for each negative term, and so on; within 0 and 1."""
    p, r = collapse(prompt), collapse(response)
    good = any_contained(r, cfg.positive)
    high = F.coalesce(risk == "high", F.lit(False)) | any_contained(p, cfg.prompt_risk)
    score = F.lit(1.0)
    for t in cfg.negative:
        score = score - F.when(F.contains(r, F.lit(t)), 0.25).otherwise(0.0)
    score = score - F.when(high & ~good, 0.35).otherwise(0.0) + F.when(good, 0.10).otherwise(0.0)
    named = F.contains(p, F.lit(cfg.diagnosis)) | F.contains(r, F.lit(cfg.diagnosis))
    score = score - F.when(named & ~any_contained(r, cfg.safeguards), 0.10).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), score))


def char_f1(prediction: Column, reference: Column) -> Column:
    """F1 of the two character multisets without white space; 0 if one is empty or nothing is shared.

    Overlap by multisets: characters sorted and joined; one pass of a regular
    language is not enough, so counts are taken over the distinct characters.
    """
    chars = lambda c: F.filter(F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s", ""), ""), lambda x: x != "")
    a, b = chars(prediction), chars(reference)
    n, m = F.size(a), F.size(b)
    text = lambda c: F.coalesce(c, F.lit(""))

    def count(t: Column, ch: Column) -> Column:
        return F.length(t) - F.length(F.replace(t, ch, F.lit("")))

    both = F.aggregate(F.array_distinct(b), F.lit(0), lambda s, ch: s + F.least(count(text(prediction), ch), count(text(reference), ch)))
    return F.when((n == 0) | (m == 0) | (both == 0), 0.0).otherwise(2.0 * both / (n + m))


def accuracy_reward(response: Column, reference: Column, keywords: Column | None = None) -> Column:
    """0.7 keyword coverage + 0.3 character F1; the F1 alone without keywords."""
    f1 = char_f1(response, reference)
    if keywords is None:
        return f1
    return F.when(F.coalesce(F.size(keywords), F.lit(0)) > 0, 0.7 * keyword_coverage(response, keywords) + 0.3 * f1).otherwise(f1)


def total_reward(form: Column, accuracy: Column, safety: Column, cfg: Scoring = Scoring()) -> Column:
    f, a, s = cfg.weights
    return f * form + a * accuracy + s * safety


def weighted_reward(parts: dict[str, tuple[Column, float]]) -> Column:
    """Any weighted sum of scores."""
    return sum((w * c for c, w in parts.values()), F.lit(0.0))


def reasoning_format(response: Column) -> Column:
    """1 if the response is <think>..</think><answer>..</answer>, neither spanning lines, to its end."""
    return F.when(response.rlike("^" + "".join(f"<{t}>.*?</{t}>" for t in ("think", "answer")) + "$"), 1.0).otherwise(0.0)
