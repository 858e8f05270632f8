import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import convert, dedup, metrics, sample, similarity
from tessera.plans import catalog


def test_keep_first_and_best(spark):
    df = spark.createDataFrame([(1, "A b"), (2, "ab"), (3, None), (4, None), (5, "c")], "i int, t string")
    key = F.when(F.col("t").isNotNull(), dedup.pair_key(F.lit("q"), F.col("t")))
    assert sorted(r.i for r in dedup.keep_first(df, key, [F.col("i")]).collect()) == [1, 3, 4, 5]
    best = spark.createDataFrame([("Q", 1.0, 1), ("q ", 2.0, 2), ("r", None, 3), ("r", None, 4)], "q string, s double, i int")
    assert sorted(r.i for r in dedup.best_answer(best, F.col("q"), F.col("s"), F.col("i")).collect()) == [2, 3]
    assert dedup.keep_first(df.limit(0), key, [F.col("i")]).count() == 0


def test_stratified(spark):
    for high, rest, n, want in ((50, 100, 10, (3, 7)), (2, 100, 10, (2, 8)), (50, 4, 10, (6, 4)), (5, 5, 7, (2, 5)), (3, 4, 10, None)):
        df = spark.range(high + rest).withColumn("h", F.col("id") < high)
        if want is None:
            with pytest.raises(ValueError):
                sample.stratified(df, n, F.col("h"), "id")
            continue
        got = [r.h for r in sample.stratified(df, n, F.col("h"), "id").collect()]
        assert (sum(got), len(got) - sum(got)) == want


def test_samples_do_not_hang_on_partitions(spark):
    df = spark.range(1000)
    a = [r.id for r in sample.hash_sample(df, 20, "id").collect()]
    assert a == [r.id for r in sample.hash_sample(df.repartition(7), 20, "id").collect()] and len(set(a)) == 20
    assert sample.hash_split(df, "id", 0.1).where("split = 'val'").count() in range(60, 140)
    assert sample.ordered_split(df, 0.1, "id").where("split = 'val'").count() == 100
    assert sample.ordered_split(df.limit(0), 0.1, "id").count() == 0
    with pytest.raises(ValueError):
        sample.head_sample(df, 1001, "id", strict=True)


def test_top_k(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.5), (2, 0.9), (3, None)], "i int, s double")
    assert [r.i for r in similarity.top_k(df, 2, "s", "i").collect()] == [2, 0]
    assert similarity.top_k(df.repartition(3), 9, "s", "i").count() == 4
    with pytest.raises(ValueError):
        similarity.top_k(df, 0, "s", "i")


def test_best_targets_in_parts(spark, monkeypatch):
    rng = np.random.default_rng(1)
    c, t = rng.normal(size=(40, 5)), rng.normal(size=(9, 5))
    t[3] = t[7]
    cand = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)] + [(99, None), (98, [0.0] * 5)], "i int, v array<double>")
    tgt = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(t)], "k long, w array<double>")
    p = (c / np.linalg.norm(c, axis=1, keepdims=True)) @ (t / np.linalg.norm(t, axis=1, keepdims=True)).T
    for size in (1 << 20, 100):
        monkeypatch.setattr(similarity, "PART_BYTES", size)
        got = {r.i: r for r in similarity.best_targets(cand, tgt, "v", "k", "w").collect()}
        assert [got[i].best_target_id for i in range(40)] == [int(np.round(x, 12).argmax()) for x in p]
        assert [got[i].similarity_score for i in range(40)] == pytest.approx(p.max(1).tolist())
        assert got[99].similarity_score is None and got[98].similarity_score == 0.0
    with pytest.raises(ValueError):
        similarity.best_targets(cand, tgt.limit(0), "v", "k", "w")


def test_hash_vectors(spark):
    v = similarity.hash_vectors(["a b a", "", None, "  "], 16)
    assert np.allclose(np.linalg.norm(v, axis=1), 1)
    assert v[1].max() == 1.0 and np.allclose(v[1], v[2])
    df = spark.createDataFrame([(0, "a b a"), (1, None)], "i int, t string")
    got = {r.i: r.embedding for r in similarity.hash_embed(df, "t", 16).collect()}
    assert np.allclose(got[0], v[0]) and np.allclose(got[1], v[1])


def test_best_hashed(spark):
    texts = [(i, f"w{i % 7} w{i % 5} x" if i % 9 else None if i % 2 else "") for i in range(1100)] + [(2000, "long" * 100 + " w1")]
    df, tgt = spark.createDataFrame(texts, "i int, t string").coalesce(1), spark.createDataFrame([("b", "w1 w2"), ("a", "w1 w2"), ("c", "x w3 w4"), ("d", None)], "k string, u string")
    got = {r.i: r for r in similarity.best_hashed(df, tgt, "t", "k", "u", 64).collect()}
    m = similarity.hash_vectors(["w1 w2", "x w3 w4", None], 64)
    for i, t in texts:
        p = np.round(similarity.hash_vectors([t], 64)[0] @ m.T, 12)
        assert got[i].best_target_id == "acd"[p.argmax()] and got[i].similarity_score == pytest.approx(p.max())
    # the same by way of a column of vectors
    by = similarity.best_targets(similarity.hash_embed(df, "t", 64), similarity.hash_embed(tgt, "u", 64), "embedding", "k", "embedding", normalized=True)
    assert {r.i: (r.best_target_id, r.similarity_score) for r in by.collect()} == {i: (r.best_target_id, r.similarity_score) for i, r in got.items()}


def test_hash_embed_best_holds_slices(spark, sf):
    """Vectors of a batch of 10,000 rows take 30 MB and never exist at once, in the worker or between two workers."""
    matrix, ids = similarity.hash_vectors([f"t{i}" for i in range(200)], 384), pa.array(range(200))
    score = similarity._scorer(SimpleNamespace(value=(matrix, ids)), lambda part: similarity._text_vectors(part, 384), True)
    batch = pa.array([f"t{i} t{i + 1}" for i in range(10_000)])
    tracemalloc.start()
    try:
        n = sum(map(len, score(iter([batch]))))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == len(batch) and peak < 16e6
    plan = catalog.hash_embed_best(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "array<double>" not in plan


def test_templates(spark):
    df = spark.createDataFrame([(" i ", None, "o")], "a string, b string, c string")
    args = F.col("a"), F.col("b"), F.col("c")
    assert df.select(similarity.candidate_text(*args).alias("x")).first().x == "指令：i\n问题：\n回答：o"
    assert "\\n" in df.select(similarity.candidate_text(*args, similarity.Similarity(literal_escapes=True)).alias("x")).first().x
    s = F.array(F.lit(1.0), F.lit(3.0), F.lit(2.0))
    assert df.select(similarity.rank_scores(s, "mean_top_k", 2).alias("x")).first().x == 2.5
    assert df.select(similarity.rank_scores(s, "weighted", weights=F.array(F.lit(1.0), F.lit(0.0), F.lit(1.0))).alias("x")).first().x == 1.5


def test_masks(spark):
    def ids(p, a, most):
        x, y = convert.masked(F.array(*map(F.lit, p)).cast("array<int>"), F.array(*map(F.lit, a)).cast("array<int>"), most)
        r = spark.range(1).select(x.alias("x"), y.alias("y")).first()
        return r.x, r.y

    assert ids([1, 2, 3], [7, 8], 4) == ([2, 3, 7, 8], [-100, -100, 7, 8])
    assert ids([1, 2], [7, 8, 9], 3) == ([7, 8, 9], [7, 8, 9])
    assert ids([1], [7, 8, 9], 2) == ([7, 8], [7, 8])
    assert ids([], [], 2) == ([], [])
    t = spark.createDataFrame([([([1, 2], [3]), ([4], [5]), ([6] * 9, [7] * 9)],)], "t array<struct<source:array<int>,target:array<int>>>")
    x, y = convert.masked_turns(F.col("t"), 10, 0)
    r = t.select(x.alias("x"), y.alias("y")).first()
    assert r.x == [1, 2, 3, 0, 4, 5, 0] and r.y == [-100, -100, 3, 0, -100, 5, 0]


def test_format_prompt(spark):
    df = spark.createDataFrame([(1, "p", "true"), (2, "q", None)], "i int, prompt string, format_prompt_enabled string")
    once = convert.add_format_prompt(df, "F:")
    assert [r.prompt for r in once.orderBy("i").collect()] == ["F:p", "F:q"]
    assert convert.add_format_prompt(once, "F:").select(sorted(once.columns)).orderBy("i").collect() == once.select(sorted(once.columns)).orderBy("i").collect()
    on = spark.createDataFrame([("p", True)], "prompt string, format_prompt_enabled boolean")
    r = convert.add_format_prompt(on, "F:").first()
    assert (r.prompt, r.original_prompt) == ("p", "p")
    with pytest.raises(Exception, match="no prompt"):
        convert.add_format_prompt(spark.createDataFrame([(None,)], "prompt string"), "F:").collect()


def test_pair_invariants_and_records(spark):
    rows = [("q\r\n", "a", "b", "c", "d", "c", "e"), ("", "a", "b", "c", "d", "A", None), ("q", "a", "b", None, "d", "A", None), ("q", "a", "b", "c", "d", "E", None), ("q", "a", "b", "c", "d", None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, question string, A string, B string, C string, D string, answer string, explanation string")
    rec = convert.benchmark_records(df, F.lit("basic"), F.lit("dev"), F.col("i"), {"basic": "基础"})
    assert [r.reason for r in rec.orderBy("id").collect()] == [None, "missing_question", "missing_option", "invalid_answer", "missing_answer"]
    left, right = convert.question_only(rec), convert.question_with_answer(rec)
    assert [r.id for r in left.collect()] == [r.id for r in right.collect()] == ["basic-dev-0"]
    assert "answer" not in left.columns and "答案" not in left.first().target_text
    r = right.first()
    assert r.answer_text == r.options[r.answer] == "c"


def test_projections(spark):
    df = spark.createDataFrame([("i", " n ", "o"), ("", "", "o"), ("i", "", "")], "instruction string, input string, output string")
    assert [[tuple(t) for t in r.conversations] for r in convert.single_to_chat(df).collect()] == [[("human", "i\n\nn"), ("gpt", "o")]]
    assert convert.single_to_chat_raw(df).count() == 3
    rec = convert.source_record(df, F.lit(1), "src").collect()
    assert [r.reason for r in rec] == [None, None, "missing_output"] and rec[1].instruction
    long = convert.long_text_rows(spark.createDataFrame([("i", "n", "x" * 200, 5), ("i", "n", "x" * 199, 6)], "instruction string, input string, output string, row_id long"), F.lit(9))
    assert [(r.source_row_id, r.output_char_length) for r in long.collect()] == [("5", 200)]


def test_perplexity_and_metrics(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 3.0, 3), ("b", 100.0, 2), ("c", 1.0, 0), ("c", None, 4)], "g string, l double, n int")
    got = {r.g: r for r in metrics.perplexity(df, F.col("l"), F.col("n"), ["g"]).collect()}
    assert got["a"].nll == 2.5 and got["a"].ppl == pytest.approx(np.exp(2.5))
    assert got["b"].ppl == float("inf") and got["c"].ppl is None and got["c"].skipped == 2
    acc = {r.grp: r.accuracy for r in metrics.macro_accuracy(spark.createDataFrame([("x", True), ("x", False), ("y", True)], "s string, ok boolean"), "s", F.col("ok")).collect()}
    assert acc == {"x": 0.5, "y": 1.0, None: 0.75}
    a = spark.createDataFrame([(1, True), (2, False), (3, True), (4, True)], "k int, ok boolean")
    b = spark.createDataFrame([(1, False), (2, True), (3, True), (5, True)], "k int, ok boolean")
    assert {r.outcome: r.n for r in metrics.run_diff(a, b, "k", "ok").collect()} == {"broken": 1, "fixed": 1, "same": 1, "only_before": 1, "only_after": 1}
    assert metrics.share(a.limit(0), F.col("ok")).first().ratio == 0.0
