"""Text normalisation as Column -> Column functions.

Only entity decoding and NFKC leave the JVM, in one Arrow UDF that is sent just
the texts that can change; all else is regular expressions within codegen.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Unicode white space, as one class; Java's \s alone is ASCII.
SPACE = r"(?U)\s"
_CHANGES = r"&|[^\x00-\x7F]"


#: Longer than any code point's number; Python refuses to read some of them.
_LONG_NUMBER = re.compile("&#0*[1-9][0-9]{9,};?")


def unescape(text: str) -> str:
    """``html.unescape``, also of decimal numbers of any length: like all beyond Unicode these become U+FFFD."""
    try:
        return html.unescape(text)
    except ValueError:
        return html.unescape(_LONG_NUMBER.sub("&#x110000;", text))


def _fold_one(text: str | None) -> str | None:
    return None if text is None else unicodedata.normalize("NFKC", unescape(text))


@F.pandas_udf(StringType())
def _fold(texts: pd.Series) -> pd.Series:
    return texts.map(_fold_one, na_action="ignore")


@F.pandas_udf(ArrayType(StringType()))
def _fold_all(lists: pd.Series) -> pd.Series:
    return lists.map(lambda xs: None if xs is None else [_fold_one(x) for x in xs])


def strip(text: Column) -> Column:
    """Without white space (Unicode) at both ends; null stays null."""
    # a run is tried once, at its start, so that time is linear in the text
    return F.regexp_replace(text, r"(?U)^\s++|(?<!\s)\s++$", "")


def up_to_last(text: Column, mark: str) -> tuple[Column, Column]:
    """(the text up to and with the last mark, the rest): what a pattern that ends in the mark can match, so that it never scans in vain."""
    rest = F.when(F.contains(text, F.lit(mark)), F.substring_index(text, mark, -1)).otherwise(text)
    return F.substring(text, F.lit(1), F.length(text) - F.length(rest)), rest


def tidy(folded: Column) -> Column:
    """What ``normalize`` does after decoding and NFKC: tags, control and zero-width characters, spaces, lines."""
    head, rest = up_to_last(folded, ">")
    t = F.when(F.contains(folded, F.lit("<")), F.concat(F.regexp_replace(head, "<[^>]++>", " "), rest)).otherwise(folded)
    t = F.regexp_replace(t, r"[\x{FEFF}\x{200B}\x7F\x0E-\x1F\x0B\x0C\x00-\x08]", "")
    # single spaces, most of all, stay as they are
    t = F.regexp_replace(t, r"[\t\r][ \t\r]*+| [ \t\r]++", " ")
    t = F.regexp_replace(t, r"[\x{85}\x{2028}\x{2029}]", "\n")
    t = F.regexp_replace(t, r"(?U)\n[\s&&[^\n]]++", "\n")
    t = F.regexp_replace(t, r"(?U)(?<![\s&&[^\n]])[\s&&[^\n]]++\n", "\n")
    return strip(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def normalize(text: Column) -> Column:
    """Entities decoded once, NFKC, tags to a space, control and zero-width characters out, spaces to one, lines stripped, at most one blank line; null is ''.

    A lone CR is a space; VT and FF vanish; NEL and the Unicode separators end lines.
    """
    return tidy(folded(text))


def folded(text: Column) -> Column:
    """Entities decoded once and NFKC, for use before ``tidy``; null is ''."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.coalesce(_fold(F.when(text.rlike(_CHANGES), text)), text)


def fold_all(texts: Column) -> Column:
    """Decoding and NFKC over an array of strings, for use before ``tidy`` inside of ``transform``."""
    return F.coalesce(_fold_all(F.when(F.exists(texts, lambda t: t.rlike(_CHANGES)), texts)), texts)


def strip_tags(text: Column) -> Column:
    """``normalize`` without decoding and NFKC: JVM only; null is ''."""
    return tidy(F.coalesce(text, F.lit("")))


def compact(text: Column) -> Column:
    """Lower case without any white space: what exact keys compare."""
    return F.lower(F.regexp_replace(text, SPACE, ""))


def content_chars(text: Column) -> Column:
    """Code points that aren't white space."""
    return F.length(F.regexp_replace(text, SPACE, ""))


def collapse(text: Column) -> Column:
    """White space runs to one space, ends stripped; null is ''."""
    return strip(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE + "+", " "))


def collapse_lower(text: Column) -> Column:
    return F.lower(collapse(text))


def unix_lines(text: Column) -> Column:
    """CRLF and CR to LF, ends stripped; null is ''."""
    return strip(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "\r\n?", "\n"))


def plain(text: Column) -> Column:
    """Any scalar as a string with its ends stripped; null is ''."""
    return strip(F.coalesce(text.cast("string"), F.lit("")))


def tagged_answer(text: Column) -> Column:
    """The stripped inside of the first <answer> element, or the whole text if there is none."""
    head, _ = up_to_last(text, "</answer>")
    inside = F.regexp_extract(head, r"(?s)<answer>(.*?)</answer>", 1)
    return strip(F.when(head.rlike(r"(?s)<answer>.*?</answer>"), inside).otherwise(text))


def equal_answers(response: Column, reference: Column) -> Column:
    """1 if the tagged (or final) answers are equal once their ends are stripped, else 0."""
    return F.coalesce((tagged_answer(final_answer(response)) == tagged_answer(final_answer(reference))).cast("double"), F.lit(0.0))


def final_answer(text: Column) -> Column:
    """What follows the last ####, stripped; the whole text if there is none."""
    return strip(F.element_at(F.split(text, "####"), -1))


def is_cjk(text: Column) -> Column:
    """Whether every character is a unified ideograph of the basic block; an empty text is."""
    return text.rlike("^[一-龥]*$")
