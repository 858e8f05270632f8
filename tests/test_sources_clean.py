import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.plans import clean
from tessera.plans.config import Cleaning
from tessera.sources import jsonl, sinks
from tessera.sources.paged import PagedRows, with_retries
from tessera.streaming.clean import clean_stream


def put(path, lines):
    os.makedirs(path.parent, exist_ok=True)
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x, ensure_ascii=False) for x in lines) + "\n", encoding="utf-8")


GREETING = [{"from": r, "value": v} for r, v in (("gpt", "hello"), ("human", "one"), ("human", "two"), ("gpt", "fine answer"))]


def test_smoke_corpus(spark, tmp_path):
    put(tmp_path / "in/a.jsonl", [
        {"question": "what is it then", "answer": "a long enough answer"},
        {"query": "What  is it then", "response": "A long enough answer"},
        {"question": "is it so", "answer": "请加微信 13812345678 for more of it"},
        {"instruction": "explain", "input": "the thing", "output": "a thing is a thing"},
        {"conversations": GREETING},
        {"question": "q", "answer": "no"},
    ])
    put(tmp_path / "in/sub/b.jsonl", ["{bad", "", "[1]", {"conversations": "text"}, {"conversations": [], "question": "empty list here", "answer": "goes to single turn"}, {"question": 0, "query": "Q"}, {"messages": [{"role": "user", "content": "hi there"}, {"role": "assistant", "content": "see www.x.y"}]}])
    c = clean.classify(jsonl.lines(spark, str(tmp_path / "in")))
    r = clean.report(c).first().asDict()
    assert r == {"total_read": 12, "input_files": 2, "invalid_json": 1, "invalid_record": 1, "multi_turn_failed": 1, "ad_or_contact": 2, "duplicate": 1, "empty_field": 1, "too_short": 1, "too_long": 0, "multi_turn_repaired": 1, "single_kept": 3, "multi_kept": 1, "kept": 4}
    assert [[tuple(m) for m in x.conversations] for x in clean.kept_chats(c).collect()] == [[("human", "one\ntwo"), ("gpt", "fine answer")]]
    assert {x.input for x in clean.kept_pairs(c).collect()} == {"what is it then", "the thing", "empty list here"}
    off = clean.report(clean.classify(jsonl.lines(spark, str(tmp_path / "in")), Cleaning(dedup=False))).first()
    assert off.duplicate == 0 and off.kept == 5


def test_modes(spark, tmp_path):
    put(tmp_path / "m/a.jsonl", ["", "{bad", "[1]", {"a": 1}])
    scan = jsonl.lines(spark, str(tmp_path / "m"))
    reasons = lambda mode: sorted(str(r.reason) for r in jsonl.decoded(scan, mode).collect())
    assert reasons("tolerant") == ["None", "invalid_json", "invalid_record"]
    assert reasons("skip") == ["None", "bad_json", "bad_json", "skipped"]
    for mode in ("strict", "semi"):
        with pytest.raises(Exception, match="bad line"):
            jsonl.decoded(scan, mode).collect()
    put(tmp_path / "n/a.jsonl", ["[1]", {"a": 1}])
    assert jsonl.decoded(jsonl.lines(spark, str(tmp_path / "n")), "semi").count() == 1


def test_aliases(spark):
    df = jsonl.decoded(spark.createDataFrame([(json.dumps(x),) for x in ({"question": "", "query": "Q"}, {"question": None, "title": "T"}, {"question": 0, "query": "Q"}, {"other": 1})], "value string"))
    assert [r.x for r in df.select(jsonl.first_of(Cleaning().question_fields).alias("x")).collect()] == ["Q", "T", "0", None]


def test_arrays_tsv_vocabulary(spark, tmp_path):
    (tmp_path / "a.json").write_text('\n [{"a": 1, "b": null}, {"a": 2, "b": "x"}]')
    assert jsonl.looks_like_array(spark, str(tmp_path / "a.json"))
    jsonl.array_to_lines(spark, str(tmp_path / "a.json"), str(tmp_path / "out"))
    assert not jsonl.looks_like_array(spark, str(tmp_path / "out"))
    assert jsonl.records(spark, str(tmp_path / "out")).count() == jsonl.records(spark, str(tmp_path / "a.json")).count() == 2
    (tmp_path / "t.tsv").write_text("a\tb\nc\td\n")
    assert [tuple(r) for r in jsonl.tsv(spark, str(tmp_path / "t.tsv"), ["x", "y"]).collect()] == [("a", "b"), ("c", "d")]
    (tmp_path / "v.txt").write_text("中文\t1\nab\t2\n", encoding="utf-8")
    assert [r.token for r in jsonl.vocabulary(spark, str(tmp_path / "v.txt")).collect()] == ["中文"]
    put(tmp_path / "c.jsonl", [{"conversations": GREETING}, {"conversations": GREETING[:1]}])
    assert [tuple(r) for r in jsonl.chat_pairs(spark, str(tmp_path / "c.jsonl")).collect()] == [("hello", "one")]


def test_dense_ordinal(spark):
    df = spark.range(100).select((F.col("id") * 7 % 100).alias("x"), F.repeat(F.lit("t"), F.col("id").cast("int")).alias("t"))
    assert all(r.row_id == r.x for r in jsonl.dense_ordinal(df, ["x"]).collect())
    assert jsonl.dense_ordinal(df.limit(0), ["x"]).count() == 0


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", 1, None), ("a", 2, "中")], "id string, n int, t string")
    sinks.write_pair(df, ["id", "n"], ["id", "t"], (str(tmp_path / "l"), str(tmp_path / "r")))
    read = lambda p: [json.loads(x) for f in sorted((tmp_path / p).glob("part*")) for x in f.read_text("utf-8").splitlines()]
    assert [x["id"] for x in read("l")] == [x["id"] for x in read("r")] == ["a", "b"]
    assert read("r")[1] == {"id": "b", "t": None}
    sinks.write_routed(df.withColumn("kind", F.col("id")), {"a": str(tmp_path / "ka"), "b": str(tmp_path / "kb")})
    assert [x["n"] for x in read("ka")] == [2]
    path = str(tmp_path / "l")
    sinks.rewrite(spark.read.json(path).withColumn("n", F.col("n") + 1), path, str(tmp_path / "bak"))
    sinks.rewrite(spark.read.json(path).withColumn("n", F.col("n") + 1), path, str(tmp_path / "bak"))
    assert sorted(x["n"] for x in read("l")) == [3, 4] and sorted(x["n"] for x in read("bak")) == [1, 2]
    report = str(tmp_path / "rep.json")
    sinks.write_report(df.agg(F.count("n").alias("n"), F.max("t").alias("t")), report)
    assert sinks.merge_report({"n": 5}, report) == {"n": 5, "t": "中"}
    (tmp_path / "rep.json").write_text("{")
    assert sinks.merge_report({"n": 1}, report) == {"n": 1, "previous_report_unreadable": True}


def test_paged(spark, tmp_path):
    for k in range(0, 25, 10):
        (tmp_path / f"p{k}").write_text(json.dumps({"num_rows_total": 25, "rows": [{"row_idx": i, "row": {"q": i}} for i in range(k, min(k + 10, 25))]}))
    for n in (10, 5):
        for k in range(0, 25, 10):
            (tmp_path / f"p{k}-{n}").write_text((tmp_path / f"p{k}").read_text())
    spark.dataSource.register(PagedRows)
    load = lambda **o: spark.read.format("paged_rows").options(url=f"file://{tmp_path}/p{{offset}}-{{length}}", page=10, **o).load()
    assert sorted(r.row_idx for r in load().collect()) == list(range(25))
    assert load(limit=10).count() == 10
    waits, calls = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 6:
            raise OSError
        return {}

    assert with_retries(flaky, 5, wait=waits.append) == {} and waits == [1, 2, 4, 8, 8]


def test_paged_without_total_and_short_pages(spark, tmp_path):
    def serve(name, offset, length, n, **more):
        (tmp_path / f"{name}{offset}-{length}").write_text(json.dumps(more | {"rows": [{"row": {"q": i}} for i in range(offset, offset + n)]}))

    spark.dataSource.register(PagedRows)
    load = lambda name, **o: sorted(r.row_idx for r in spark.read.format("paged_rows").options(url=f"file://{tmp_path}/{name}{{offset}}-{{length}}", page=10, retries=0, **o).load().collect())
    for k, n in ((0, 10), (10, 10), (20, 4)):
        serve("short", k, 10, n)
    serve("short", 10, 3, 3)
    assert load("short") == list(range(24)) and load("short", limit=13) == list(range(13))
    for k, n in ((0, 10), (10, 10), (20, 0)):
        serve("empty", k, 10, n, num_rows_total=None)
    assert load("empty") == list(range(20))
    # within a known total the rest of a short page is asked for again
    for k, length, n in ((0, 10, 7), (7, 3, 3), (10, 10, 10), (20, 5, 5)):
        serve("known", k, length, n, num_rows_total=25)
    assert load("known") == list(range(25))
    serve("known", 7, 3, 0, num_rows_total=25)
    with pytest.raises(Exception, match="no rows from 7 on"):
        load("known")


def test_stream(spark, tmp_path):
    out, cp = str(tmp_path / "o"), str(tmp_path / "cp")
    put(tmp_path / "s/a.jsonl", [{"question": "what is it then", "answer": "a long enough answer"}] * 2)
    clean_stream(spark, str(tmp_path / "s"), out, cp).awaitTermination()
    put(tmp_path / "s/b.jsonl", [{"question": "what is it then", "answer": "a long enough answer"}, {"question": "something new", "answer": "another long answer"}])
    clean_stream(spark, str(tmp_path / "s"), out, cp).awaitTermination()
    assert sorted(r.input for r in spark.read.parquet(out).collect()) == ["something new", "what is it then"]


def test_texts_are_normalised_once(spark):
    """The plan has the chain of patterns once a field and twice for turns, however often their results are used."""
    scan = spark.createDataFrame([("f", 0, "{}")], "file string, ord long, value string")
    plan = clean.report(clean.classify(scan))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("{3,}") <= 7
