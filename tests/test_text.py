import html
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.rules import is_ad


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("x")).first().x


def test_long_runs_take_linear_time(spark):
    """1 MB of one thing, within seconds (each took hours when a pattern looked at a run from each of its characters)."""
    import time

    runs = ["<" * 1_000_000, "\u3000" * 1_000_000, "a" + " " * 1_000_000 + "b", "a" * 1_000_000, "<answer>" * 120_000, "&#" + "1" * 1_000_000 + ";", "a\n \n" * 200_000, "\u3000\n" * 400_000 + "x"]
    df = spark.createDataFrame([(x,) for x in runs], "t string").repartition(8)
    began = time.time()
    rows = df.select(T.normalize(F.col("t")).alias("n"), T.strip_tags(F.col("t")).alias("s"), T.plain(F.col("t")).alias("p"), T.collapse(F.col("t")).alias("c"), T.tagged_answer(F.col("t")).alias("a"), is_ad(F.col("t")).alias("ad"), F.col("t")).collect()
    assert time.time() - began < 60
    by = {r.t: r for r in rows}
    assert by[runs[0]].n == runs[0] and by[runs[1]].n == by[runs[1]].p == "" and by[runs[2]].c == "a b" and by[runs[5]].n == "\ufffd" and by[runs[7]].s == "x"


CASES = [
    (None, ""), ("", ""), ("A\x00B​C﻿D", "ABCD"), ("a \t 　 b", "a b"), ("a\x0bb", "ab"), ("a b", "a\nb"), ("x\r\ny", "x\ny"),
    ("x\ry", "x y"), ("a\n\n\n\nb", "a\n\nb"), ("&lt;b&gt;hi&lt;/b&gt;", "hi"), ("１２３？", "123?"), ("＜b＞t", "t"), ("p<3 and q>1", "p 1"), ("&amp;lt;x", "&lt;x"), ("  a \n  b  \n", "a\nb"),
]


def test_normalize_cases(spark):
    df = spark.createDataFrame([(k, v) for k, (v, _) in enumerate(CASES)], "k int, t string")
    got = {r.k: r.x for r in df.select("k", T.normalize(F.col("t")).alias("x")).collect()}
    assert [got[k] for k in range(len(CASES))] == [w for _, w in CASES]


def plain_normalize(t):
    t = unicodedata.normalize("NFKC", html.unescape(t))
    t = re.sub("<[^>]+>", " ", t)
    t = re.sub("[\x7f\x0e-\x1f\x0b\x0c\x00-\x08]", "", t).replace("​", "").replace("﻿", "")
    t = re.sub("[ \t\r]+", " ", t)
    t = "\n".join(x.strip() for x in t.splitlines())
    return re.sub("\n{3,}", "\n\n", t).strip()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab<>&;lt \t\n\r 　 é１\x0b", max_size=30), min_size=1, max_size=40))
def test_normalize_equals_plain_python(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = {r.k: r.x for r in df.select("k", T.normalize(F.col("t")).alias("x")).collect()}
    assert [got[k] for k in range(len(texts))] == [plain_normalize(t) for t in texts]


def test_whole_long_text(spark):
    long = "<p>word &amp; word</p>\n" * 200_000
    assert one(spark, T.normalize, long) == "\n".join(["word & word"] * 200_000)


@pytest.mark.parametrize(("f", "value", "want"), [
    (T.compact, " Ab　C\n", "abc"), (T.collapse, " a \n b ", "a b"), (T.collapse, None, ""), (T.collapse_lower, " A\nb", "a b"), (T.unix_lines, "a\r\nb\rc ", "a\nb\nc"),
    (T.plain, "　x\n", "x"), (T.plain, None, ""), (T.tagged_answer, "z <answer> a\nb </answer> c", "a\nb"), (T.tagged_answer, " q ", "q"), (T.final_answer, "x #### 4 ", "4"), (T.final_answer, "x", "x"),
    (T.content_chars, "a b c", 3), (T.is_cjk, "中文", True), (T.is_cjk, "中a", False), (T.is_cjk, "", True), (T.strip, None, None),
])
def test_small_functions(spark, f, value, want):
    assert one(spark, f, value) == want
