"""Keyword extraction: one Arrow UDF over whole texts (native array functions take some ten times as long)."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.config import Cases

#: Commas, stops, colons, semicolons, brackets, slashes and white space (of Unicode) end a term; quotes, question and exclamation marks don't.
BORDERS = r"[\s,.;:，。；：、（）()\[\]【】<>《》/\\]+"


#: A Python worker holds the terms of at most so many rows at a time, and one text as a string.
SLICE_ROWS = 512
_TERMS = pa.list_(pa.string())


def terms(text: str | None, cfg: Cases = Cases(), borders: str = BORDERS) -> list[str]:
    """The most frequent terms of 2 to 16 characters: by count, then shorter, then earlier.

    Digits alone and stopwords are no terms. Hint terms and risk terms that occur in the text but
    are no terms by themselves are added once, in their order. A null text has none.
    """
    if not text:
        return []
    found = Counter(t for t in re.split(borders, text) if 2 <= len(t) <= 16 and t not in cfg.stopwords and not t.isdecimal())
    for hint in (*cfg.hints, *cfg.risk_terms):
        if hint not in found and hint in text:
            found[hint] = 1
    # a counter keeps the order of first places, and sorting is stable
    return sorted(found, key=lambda t: (-found[t], len(t)))[: cfg.keywords]


def ranked_terms(text: Column, cfg: Cases = Cases(), borders: str = BORDERS) -> Column:
    """``terms`` as a column."""

    @F.arrow_udf("array<string>")
    def ranked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for at in range(0, len(texts), SLICE_ROWS):
                yield pa.array([terms(t.as_py(), cfg, borders) for t in texts.slice(at, SLICE_ROWS)], _TERMS)

    return ranked(text)


def answer_keywords(answer: Column, prompt: Column, cfg: Cases = Cases()) -> Column:
    """Terms of the answer, or of the prompt if it has none; null if neither has."""

    @F.arrow_udf("array<string>")
    def either(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for answers, prompts in batches:
            for at in range(0, len(answers), SLICE_ROWS):
                both = zip(answers.slice(at, SLICE_ROWS), prompts.slice(at, SLICE_ROWS), strict=True)
                yield pa.array([terms(a.as_py(), cfg) or terms(p.as_py(), cfg) or None for a, p in both], _TERMS)

    return either(answer, prompt)
