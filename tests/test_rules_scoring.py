from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.functions import rules as R
from tessera.functions import scoring as S
from tessera.operators.keywords import answer_keywords, ranked_terms
from tessera.plans.config import Cases, Cleaning, Scoring, load


def ask(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def L(x):
    return F.lit(x)


@pytest.mark.parametrize(("q", "a", "want"), [
    (3, 50, "too_short"), (4, 50, None), (2048, 50, None), (2049, 50, "too_long"), (10, 9, "too_short"), (10, 10, None), (10, 8192, None), (10, 8193, "too_long"), (3, 9000, "too_short"), (0, 9000, "empty_field"),
])
def test_length_bounds(spark, q, a, want):
    assert ask(spark, R.length_reason(L("x " * q), L("y\n" * a))) == want
    assert ask(spark, R.length_reason(L(None).cast("string"), L("y"))) == "empty_field"


@pytest.mark.parametrize(("text", "want"), [
    ("see https://a.b", True), ("WWW.x", True), ("13812345678", True), ("12812345678", False), ("a@b.co", True), ("vx: ab", False), ("QQ12345", True), ("请加微信", True), ("plain", False),
])
def test_ads(spark, text, want):
    assert ask(spark, R.is_ad(L(text))) is want


def test_benchmark_reasons(spark):
    def reason(q="q", c="c", answer="A"):
        return ask(spark, R.benchmark_reason(L(q), {"A": L("a"), "B": L("b"), "C": L(c), "D": L("d")}, L(answer).cast("string")))

    assert [reason(), reason(q=" "), reason(c=""), reason(answer=None), reason(answer="e"), reason(answer="c")] == [None, "missing_question", "missing_option", "missing_answer", "invalid_answer", None]


def test_high_risk_and_preference(spark):
    assert ask(spark, R.is_high_risk(L("突发胸痛"), L("x"))) and not ask(spark, R.is_high_risk(L("感冒"), L("多喝水")))
    assert ask(spark, R.preference_fits(L("ab"), L("c"), L("d"), 3)) and not ask(spark, R.preference_fits(L("ab"), L("cc"), L("d"), 3))
    assert not ask(spark, R.preference_fits(L(None).cast("string"), L(""), L("d"), 3))


def test_chat_valid(spark):
    kind = "array<struct<from:string,value:string>>"
    chat = lambda *ts: F.array(*(F.struct(L(a).alias("from"), L(b).cast("string").alias("value")) for a, b in ts)).cast(kind)
    assert ask(spark, R.valid_chat(chat(("system", "s"), ("human", "")))) is True
    assert ask(spark, R.valid_chat(chat())) is True
    assert ask(spark, R.valid_chat(chat(("user", "s")))) is False
    assert ask(spark, R.valid_chat(chat(("human", None)))) is False
    assert ask(spark, R.valid_chat(L(None).cast(kind))) is False


def test_format_scores(spark):
    full = "病情分析 处理建议 风险提示 就医建议"
    for n, want in ((0, 0.0), (2, 0.5), (4, 1.0)):
        r = " ".join(full.split()[:n])
        assert ask(spark, S.format_score(L(r))) == want and ask(spark, S.format_reward(L(r))) == want
    blank = F.array(L("a"), L(" "))
    assert ask(spark, S.format_score(L("zz"), blank)) == 0.5 and ask(spark, S.format_reward(L("zz"), blank)) == 0.0
    assert ask(spark, S.missing_sections(L("病情分析"))) == [s for s in Scoring().sections if s != "病情分析"]


def test_coverages(spark):
    assert ask(spark, S.keyword_coverage(L("Use an ECG"), ("ecg", "mri", " "))) == 0.5
    assert ask(spark, S.keyword_coverage(L("x"), F.array().cast("array<string>"))) == 0.0
    assert ask(spark, S.keyword_coverage(L("x"), L(None).cast("array<string>"))) == 0.0
    cover = lambda p, r, k: ask(spark, S.safety_coverage(L(p), L(r), L(k)))
    assert [cover("p", "不用检查 急诊", "high"), cover("p", "r", "high"), cover("p", "急诊", "high"), cover("p", "r", "normal"), cover("胸痛", "r", "normal")] == [0, 0, 1, 1, 0]


def test_rewards(spark):
    assert ask(spark, S.safety_reward(L("胸痛怎么办"), L("不用检查，在家休息即可。"), L("high"))) == pytest.approx(0.40)
    f1 = lambda a, b: ask(spark, S.char_f1(L(a), L(b)))

    def plain(a, b):
        x, y = Counter(a), Counter(b)
        n = sum((x & y).values())
        return 2 * n / (len(a) + len(b)) if n else 0.0

    for a, b in (("aab", "abb"), ("中文中", "文文"), ("ab", "cd"), ("a.*$", "$$*"), ("\U0001f600a", "\U0001f600")):
        assert f1(a, b) == pytest.approx(plain(a, b))
    assert f1("", "x") == 0.0 and f1(" a b", "ba\n") == 1.0
    acc = ask(spark, S.accuracy_reward(L("心电图 肌钙蛋白"), L("心电图"), F.array(L("心电图"), L("肌钙蛋白"))))
    assert acc > 0.7
    assert ask(spark, S.total_reward(L(1.0), L(1.0), L(1.0))) == pytest.approx(1.0)
    assert ask(spark, S.reasoning_format(L("<think>a</think><answer>b</answer>"))) == 1.0
    assert ask(spark, S.reasoning_format(L("<think>a\n</think><answer>b</answer>"))) == 0.0


def test_keywords(spark):
    cfg = Cases(hints=("core",), stopwords=("stop",))
    get = lambda t: ask(spark, ranked_terms(L(t).cast("string"), cfg))
    assert get("bb,bb,aa1,zz,ccc") == ["bb", "zz", "aa1", "ccc"]
    assert get("x, " + "y" * 17 + ", 123, stop") == []
    assert get("hardcoreterms") == ["core", "hardcoreterms"]
    assert len(get(",".join(f"t{k}" for k in range(20)))) == 8
    assert get(None) == [] and get("") == []
    assert get(" ".join(f"w{k} +1{k}" for k in range(3))) == ["w0", "w1", "w2", "+10", "+11", "+12"]
    assert ask(spark, answer_keywords(L("x"), L("term"), cfg)) == ["term"]
    assert ask(spark, answer_keywords(L("x"), L("y"), cfg)) is None


def test_keywords_of_chinese_texts(spark):
    """Worked out by hand from the contract's own lists and borders."""
    get = lambda t: ask(spark, ranked_terms(L(t)))
    # risk terms count like hints; both follow the pieces, in their order
    assert get("出现休克和昏迷的情形") == ["昏迷", "休克", "出现休克和昏迷的情形"]
    every = "诊断治疗检查症状病因并发症预防用药手术心电图肌钙蛋白血常规影像CTMRI感染炎症综合征梗死肿瘤贫血糖尿病高血压抗生素激素"
    assert get(every) == ["诊断", "治疗", "检查", "症状", "病因", "预防", "用药", "手术"]
    # quotes and bars are no borders, the ideographic space is one
    assert get("甲\"乙|丙\u3000丁戊") == ["丁戊", "甲\"乙|丙"]
    assert get("肿瘤，肿瘤") == ["肿瘤"] and get("需要，患者，１２３，12") == []
    assert get("及时处理。及时处理；多喝水") == ["及时处理", "多喝水"]


def test_sections_default_where_a_row_has_none(spark):
    full = "病情分析 处理建议 风险提示 就医建议"
    for none in (F.array().cast("array<string>"), F.lit(None).cast("array<string>")):
        assert ask(spark, S.format_score(L(full), none)) == 1.0 and ask(spark, S.format_score(L("风险提示"), none)) == 0.25
        assert ask(spark, S.missing_sections(L("x"), none)) == full.split()
        assert ask(spark, S.format_reward(L(full), none)) == 1.0
    assert ask(spark, S.format_score(L("one"), F.array(L("one"), L("two")))) == 0.5


def test_config(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text('# note\nmin_question: 7\ndedup: false\nad_keywords:\n  - "a\\nb"\n  - c # tail\nuser_roles: [x, y]\n')
    c = load(Cleaning, str(p), max_answer=9)
    assert (c.min_question, c.dedup, c.ad_keywords, c.user_roles, c.max_answer) == (7, False, ("a\nb", "c"), ("x", "y"), 9)
    assert load(Cleaning, str(tmp_path / "none.yaml")) == Cleaning()
    with pytest.raises(ValueError):
        load(Cleaning, None, nonsense=1)


def test_cases_look_for_keywords_once(spark, sf):
    """One pass through Python workers, not another one for the filter."""
    from tessera.plans import catalog

    plan = catalog.complex_cases(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
