"""Operators with SQL or an exact brute-force version: lines, suffixes, exact copies, decontamination, tokens."""

import random

import duckdb
import numpy as np
import pyarrow.orc
import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe_count, contamination, exact_stream, line_runs, queries, suffix_runs, token_orc
from tessera.llm.common import shared_dir

from .helpers import documents, longest_match, odd, words


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = queries.QUERIES[name](spark, sf)
    names = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({queries.SQL[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(str, want))
    assert want


def plain_lines(rows):
    """Rows are (id, text); equal rows share a verdict, rows of one id are ordered by text hash, which tests avoid."""
    seen, out = set(), {}
    for i, text in rows:
        if text is None or (i, text) in out:
            continue
        kept = []
        for line in text.split("\n"):
            bare = line.strip(" \t\r")
            if not bare or bare not in seen:
                kept.append(line)
            seen.add(bare)
        out[i, text] = "\n".join(kept)
    return out


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (5, 2), (9, 4)])
def test_lines_brute_force(spark, batches, fanout):
    rnd = random.Random(3)
    rows = [(i, "\n".join(rnd.choice(["a", "b ", " b", "", "c c", f"u{rnd.randrange(30)}"]) for _ in range(rnd.randrange(8)))) for i in range(60)]
    got = {(r.doc_id, r.n_lines - r.n_removed): r.text for r in line_runs.line_dedup(documents(spark, [(i, t, "en") for i, t in rows]), batches, fanout).collect()}
    want = plain_lines(rows)
    assert {k[0]: v for k, v in got.items()} == {i: t for (i, _), t in want.items()}


def test_lines_odd(spark):
    rows = [tuple(r) for r in line_runs.line_dedup(odd(spark)).collect()]
    assert len(rows) == 13
    by = {}
    for i, t, n, k in rows:
        by.setdefault(i, []).append((t, n, k))
    assert by[1] == [("one two three\nfour", 2, 0)] * 2
    assert by[2] == [(None, 0, 0)] and by[3] == [("", 0, 0)] and by[6] == [("\n \n\t", 0, 0)]
    assert [x[1:] for x in by[4] + by[5]] == [(1, 0), (1, 1)] and by[5][0][0] == ""
    nameless = sorted(x for x in by[None] if x[0] is not None)
    assert sum(k for _, _, k in nameless) == 1 and sum(n for _, n, _ in nameless) == 7
    assert line_runs.line_dedup(odd(spark).limit(0)).count() == 0


def test_line_runs_are_not_sorted_again(spark, tmp_path):
    before = {t.name for t in spark.catalog.listTables()}
    runs = line_runs.SortedRuns(spark, fanout=2, buckets=4)
    firsts = lambda a, z: spark.range(a, z).select(F.xxhash64("id").alias("h1"), F.xxhash64(F.lit("x"), "id").alias("h2")).groupBy("h1", "h2").agg(F.min(F.struct(F.lit(1).alias("id"), F.lit(0).alias("t"), F.lit(0).alias("pos"))).alias("f")).select("h1", "h2", "f.*")
    runs.add(firsts(0, 500))
    spark.conf.set(line_runs._ORDERED, "true")
    try:
        plan = runs.new(firsts(400, 600))._jdf.queryExecution().sparkPlan().toString() + str(runs.new(firsts(400, 600))._jdf.queryExecution().executedPlan())
    finally:
        spark.conf.unset(line_runs._ORDERED)
    run_side = plan[plan.rindex("SortMergeJoin") :]
    run_side = run_side[run_side.index("FileScan") - 200 :]
    assert "Bucketed: true" in run_side and "Sort [" not in run_side and "Exchange" not in run_side
    runs.add(firsts(400, 600))
    assert len(runs.levels[0]) == 0 and len(runs.levels[1]) == 1
    assert runs.close().count() == 600
    assert {t.name for t in spark.catalog.listTables()} == before


def test_a_line_batch_reads_its_own_rows(spark, tmp_path):
    spark.range(4000).selectExpr("id AS doc_id", "concat('line ', id) AS text").repartitionByRange(8, "doc_id").write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    seen = []
    store = line_runs.SortedRuns._store
    with pytest.MonkeyPatch.context() as m:
        m.setattr(line_runs.SortedRuns, "_store", lambda self, rows, level: (seen.append(str(rows._jdf.queryExecution().executedPlan())), store(self, rows, level))[1])
        assert line_runs.line_dedup(docs, batches=4, fanout=9).count() == 4000
    assert len(seen) == 4 and all("LessThanOrEqual(doc_id" in p or "GreaterThan(doc_id" in p for p in seen)


def test_suffixes_brute_force(spark):
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(4000)}" for _ in range(6000)]
    rows = []
    for i in range(25):
        w = [f"x{i}_{k}" for k in range(rnd.randrange(5, 60))]
        for _ in range(rnd.randrange(3)):
            a = rnd.randrange(5800)
            w += base[a : a + rnd.choice([49, 50, 51, 90])] + [f"y{i}_{rnd.randrange(10**6)}"]
        rows.append((i, " ".join(w)))
    for i in (30, 31):
        rows.append((i, " ".join(base[:120]) + " end"))
    rows.append((40, " ".join(base[200:260] + ["z"] + base[200:260])))
    at = {}
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - 49):
            at.setdefault(tuple(w[p : p + 50]), []).append((i, p))
    hits = {}
    for found in at.values():
        if len(found) > 1:
            for i, p in found:
                hits.setdefault(i, []).append((p, min(f[0] for f in found)))
    want = set()
    for i, ps in hits.items():
        ps.sort()
        start, last, first = ps[0][0], ps[0][0], ps[0][1]
        for p, f in [*ps[1:], (10**9, 0)]:
            if p - last >= 50:
                want.add((i, start, last + 50, first))
                start, first = p, f
            last, first = p, min(first, f)
    for size in (1 << 22, 2000):
        got = {tuple(r) for r in suffix_runs.repeated_passages(documents(spark, [(i, t, "en") for i, t in rows]), size).collect()}
        assert got == want


def test_suffixes_odd(spark):
    got = {(r.doc_id, r.start_word, r.end_word, r.first_doc_id) for r in suffix_runs.repeated_passages(odd(spark)).collect()}
    assert got == {(4, 0, 90_000, 4), (5, 0, 90_000, 4)}
    assert suffix_runs.repeated_passages(odd(spark).limit(0)).count() == 0


def test_a_passage_in_every_document(spark):
    rnd = random.Random(4)
    shared = [f"s{k}" for k in range(80)]
    rows = [(i, [f"a{i}x{k}" for k in range(rnd.randrange(60))] + shared + [f"b{i}"]) for i in range(400)]
    rows += [(1000 + k, rows[7][1]) for k in range(300)]
    df = documents(spark, [(i, " ".join(w), "en") for i, w in rows], extra=False)
    entries = []
    got = {(r.doc_id, r.start_word, r.end_word, r.first_doc_id) for r in suffix_runs.repeated_passages(df, 40_000).collect()}
    want = {(i, w.index("s0"), w.index("s0") + 80, 0) for i, w in rows if i < 1000 and i != 7} | {(i, 0, len(rows[7][1]), 0) for i in (7, *range(1000, 1300))}
    assert got == want
    # what a merge range gets of a suffix is one entry a bucket, and of an anchor one row a batch
    import pyarrow as pa

    batch = pa.record_batch([pa.array(range(400), pa.int64()), pa.array([" ".join(w) for _, w in rows[:400]])], ["t", "text"])
    found = suffix_runs.find_anchors(batch).to_pydict()
    together = [h for h, s in zip(found["h"], found["spread"], strict=True) if s == 0]
    assert len(together) == len(set(together)) and sum(found["sure"]) >= 400
    for bucket in (0, 1):
        docs_ = [(i * 2 + bucket, k) for i in range(300) for k in range(3)]
        doc, pos = (np.array(x) for x in zip(*docs_, strict=True))
        key, _, count, _ = suffix_runs.run_of(np.tile(np.arange(3, dtype=np.uint32)[:, None], (300, suffix_runs.DEPTH)).reshape(900, -1), doc, pos)
        entries.append(len(key))
        assert count.tolist() == [300] * 3
    assert entries == [3, 3]


def test_suffix_removal(spark):
    rnd = random.Random(9)
    x, y, z, own = ([f"{c}{rnd.randrange(10**6)}" for _ in range(70)] for c in "xyzo")
    rows = [(3, x + y), (5, x + y + z), (7, y + z), (40, own + ["mid"] + own), (50, x + y), (None, own[:60])]
    df = documents(spark, [(i, " ".join(w), "en") for i, w in rows] + [(60, None, "en"), (61, "", "en"), (62, "short one", "en")])
    for size in (1 << 22, 2000):
        out = suffix_runs.without_repeats(df, size)
        assert out.columns == df.columns
        got = {r.doc_id: r.text for r in out.collect()}
        assert {i: words(t) for i, t in got.items()} == {3: x + y, 5: z, 7: [], 40: [*own, "mid"], 50: [], None: [], 60: [], 61: [], 62: ["short", "one"]}
        assert got[60] is None and got[61] == "" and got[62] == "short one"
    assert suffix_runs.without_repeats(odd(spark)).count() == 13 and suffix_runs.without_repeats(odd(spark).limit(0)).count() == 0


def test_suffix_removal_brute_force(spark):
    rnd = random.Random(12)
    base = [f"w{rnd.randrange(500)}" for _ in range(900)]
    rows = []
    for i in range(25):
        w = []
        for _ in range(3):
            a = rnd.randrange(700)
            w += base[a : a + rnd.choice([40, 60, 120, 200])] + [f"u{i}"] * rnd.randrange(2)
        rows.append((i, w))
    rows += [(30, rows[4][1]), (31, ["a"] * 130)]
    first, gone = {}, set()
    for i, w in rows:
        for p in range(len(w) - 49):
            if first.setdefault(tuple(w[p : p + 50]), (i, p)) != (i, p):
                gone |= {(i, k) for k in range(p, p + 50)}
    want = {i: [t for k, t in enumerate(w) if (i, k) not in gone] for i, w in rows}
    got = {r.doc_id: words(r.text) for r in suffix_runs.without_repeats(documents(spark, [(i, " ".join(w), "en") for i, w in rows])).collect()}
    assert gone and got == want
    assert {t for w in got.values() for t in w} == {t for _, w in rows for t in w}


def test_loser_tree_merges_any_runs():
    rnd = random.Random(1)
    for k in (0, 1, 2, 3, 7):
        runs = []
        for _ in range(k):
            keys = sorted({tuple(rnd.randrange(3) for _ in range(4)) for _ in range(rnd.randrange(9))})
            lcp = [0] + [next(d for d in range(4) if a[d] != b[d]) for a, b in zip(keys, keys[1:], strict=False)]
            runs.append(([list(x) for x in keys], lcp[: len(keys)]))
        order, common = suffix_runs.merge(runs)
        heads = [iter(r[0]) for r in runs]
        merged = [next(heads[r]) for r in order]
        assert merged == sorted(x for r in runs for x in r[0])
        for n in range(1, len(merged)):
            assert common[n] == next((d for d in range(4) if merged[n][d] != merged[n - 1][d]), 4)


def test_exact_odd_and_collisions(spark):
    df = odd(spark)
    want = {(1, 1), (5, 4)}
    assert {(r.doc_id, r.duplicate_of) for r in exact_stream.exact_dedup(df, files_per_batch=1).collect()} == want
    # every digest collides: full texts must decide
    assert {(r.doc_id, r.duplicate_of) for r in exact_stream.exact_dedup(df, digest=lambda t: F.lit("00")).collect()} == want
    assert exact_stream.exact_dedup(df.limit(0)).count() == 0
    nulls = documents(spark, [(None, "q", "en"), (None, "q", "en"), (3, "q", "en"), (4, "q ", "en")])
    assert sorted(str((r.doc_id, r.duplicate_of)) for r in exact_stream.exact_dedup(nulls).collect()) == ["(None, 3)", "(None, 3)"]


def test_contamination_brute_force(spark):
    rnd = random.Random(2)
    say = lambda n, v: " ".join(f"v{rnd.randrange(v)}" for _ in range(n))
    items = [(k, say(rnd.randrange(5, 60), 3)) for k in range(6)] + [(7, "a b"), (8, ""), (9, None), (None, "q " * 12)]
    rows = [(k, say(rnd.randrange(0, 80), 3) + " ! " + (items[k % 6][1] if k % 3 == 0 else ""), "en") for k in range(30)] + [(98, "q Q " * 40, "en"), (99, None, "en"), (None, items[0][1], "en")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = set()
    for d, t, _ in rows:
        for i, x in items:
            n, p, q = longest_match(words(t), words(x))
            if n >= 10:
                want.add((d, i, n, p, q))
    docs = documents(spark, rows)
    for most in (8 << 20, 60):
        assert {tuple(r) for r in contamination.contamination(docs, bench, benchmark_bytes=most).collect()} == want
        kept = contamination.clean(docs, bench, benchmark_bytes=most)
        assert kept.columns == docs.columns
        assert {r.doc_id for r in kept.collect()} == {d for d, _, _ in rows if d not in {w[0] for w in want}}
    assert contamination.contamination(odd(spark), bench.limit(0)).count() == 0
    assert contamination.clean(odd(spark), bench.limit(0)).count() == 13
    assert contamination.contamination(odd(spark).limit(0), bench).count() == 0


def test_long_texts_take_linear_time_and_little_memory(tmp_path):
    """1 MB and 20 MB of one thing, in a process of its own: below 10 s and 1 GB each (words, matches, n-grams, pages)."""
    import pathlib
    import subprocess
    import sys

    code = """
import resource, sys, time
import numpy as np, pyarrow as pa
from tessera.llm import contamination, kernel, language, mincut_html, mixing
text = {"spaces": " ", "less": "<", "word": "q ", "tag": "<p>", "letter": "a", "script": "\u4e2d"}[sys.argv[1]]
text = text * (int(sys.argv[2]) // len(text.encode()))
raw, offsets = kernel.buffers(pa.array([text]))
item = kernel.Words(*kernel.buffers(pa.array(["q " * 1000])), scripts=True)
f = language.Filter(["a", "b", "c", "d"])
steps = {
    "matches": lambda: contamination.longest_matches(kernel.Words(raw, offsets, scripts=True), item, 10),
    "grams": lambda: f.shares(raw, offsets, f.rates(), np.zeros(1)),
    "features": lambda: mixing.features(raw, offsets),
    "page": lambda: mincut_html.main_text(text, mincut_html.DEFAULT),
}
before = time.time()
steps[sys.argv[3]]()
print(time.time() - before, resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)
"""
    root = pathlib.Path(__file__).parents[2]
    for size in (1 << 20, 20 << 20):
        for kind, step in [(k, s) for s in ("matches", "grams", "features", "page") for k in ("spaces", "less", "word", "letter", "script")] + [("tag", "page")]:
            if kind == "tag":
                size = min(size, 8 << 20)  # a tag takes some 3 microseconds
            took, peak = subprocess.run([sys.executable, "-c", code, kind, str(size), step], capture_output=True, text=True, check=True, cwd=root).stdout.split()
            assert float(took) < 10 and int(peak) < 1 << 20, (kind, step, size, took, peak)


TEXTS = ["", " ", "hello  world's end\n\n x", "naïve façade 中文字 １２ ½", "a" * 5000, "aé" * 700, "​퟿ x", "don't I'LL 12345 !!!??? \t tab", "🙂🙂 mixed 🙂", "the the the"]


def test_counts_equal_the_tokenizer(spark, sf):
    enc = token_orc.encoder()
    df = documents(spark, [(i, t, "en") for i, t in enumerate(TEXTS)])
    assert {r.doc_id: r.n_tokens for r in bpe_count.token_counts(df).collect()} == {i: len(enc.encode_ordinary(t)) for i, t in enumerate(TEXTS)}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in queries.QUERIES["op2_token_counts"](spark, sf).collect()}
    assert got == {r.doc_id: (len(r.text.encode()), len(enc.encode_ordinary(r.text))) for r in docs.collect()}
    rows = [tuple(r) for r in bpe_count.token_counts(odd(spark)).collect()]
    assert len(rows) == 13 and (2, None, None) in rows and (3, 0, 0) in rows
    assert bpe_count.token_counts(odd(spark).limit(0)).count() == 0


def test_heap_equals_plain_merging():
    known, _ = bpe_count.counter()
    ranks = token_orc.read_ranks(token_orc.VOCABULARY)

    def plain(data):
        parts = [bytes([b]) for b in data]
        while len(parts) > 1:
            r, k = min((ranks.get(parts[k] + parts[k + 1], 1 << 30), k) for k in range(len(parts) - 1))
            if r == 1 << 30:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return len(parts)

    rnd = random.Random(4)
    for _ in range(300):
        data = bytes(rnd.choice(b"aeinst th\xc3\xa9") for _ in range(rnd.randrange(40)))
        assert known.count(data) == plain(data)


def test_token_ids_equal_plain_merging(spark):
    import regex

    ranks = token_orc.read_ranks(token_orc.VOCABULARY)

    def plain(text):
        out = []
        for piece in regex.findall(token_orc.PATTERN, text):
            parts = [bytes([b]) for b in piece.encode()]
            while len(parts) > 1:
                r, k = min((ranks.get(parts[k] + parts[k + 1], 1 << 30), k) for k in range(len(parts) - 1))
                if r == 1 << 30:
                    break
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            out += [ranks[p] for p in parts]
        return out

    texts = [t if len(t) < 900 else t[:900] for t in TEXTS]
    got = {r.doc_id: r.tokens for r in token_orc.token_table(documents(spark, [(i, t, "en") for i, t in enumerate(texts)])).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def test_token_files_skip_by_statistics_and_bloom_filters(spark):
    docs = spark.range(0, 20_000, 2).selectExpr("id AS doc_id", "concat('text number ', id) AS text").coalesce(1)
    path = shared_dir(spark, "t")
    token_orc.write_tokens(docs, path)

    def rows_read(where):
        df = token_orc.read_tokens(spark, path).select("doc_id").where(where)
        found = df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        return len(found), plan.collectLeaves().head().metrics().apply("numOutputRows").value()

    assert rows_read("doc_id >= 0") == (10_000, 10_000)
    found, read = rows_read("doc_id = 5000")  # statistics: one row group of the ten
    assert found == 1 and read <= token_orc.ROW_INDEX_STRIDE
    # odd ids lie within the statistics' ranges: only the Bloom filters can rule them out
    reads = [rows_read(f"doc_id = {i}") for i in range(1, 2001, 100)]
    assert all(n == 0 for n, _ in reads) and sum(r == 0 for _, r in reads) >= 18
    token_orc.write_tokens(docs.repartition(5), path + "r", ranged=True)
    ends = sorted((min(x), max(x)) for x in ([r.doc_id for r in token_orc.read_tokens(spark, f).collect()] for f in token_orc.read_tokens(spark, path + "r").inputFiles()))
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_token_round_trip_and_metadata(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    path = shared_dir(spark, "t")
    token_orc.write_tokens(docs, path)
    enc = token_orc.encoder()
    back = {r.doc_id: enc.decode(r.tokens) for r in token_orc.read_tokens(spark, path).collect()}
    assert back == {r.doc_id: r.text for r in docs.collect()}
    one = token_orc.read_tokens(spark, path).where("doc_id = 7")
    assert [r.doc_id for r in one.collect()] == [7]
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,7)]" in one._jdf.queryExecution().toString()
    import glob

    files = glob.glob(path.removeprefix("file:").replace("//", "/") + "/*.orc")
    assert files and sum(pyarrow.orc.ORCFile(f).nrows for f in files) == docs.count()
    rows = {(r.doc_id, r.n_tokens, None if r.tokens is None else len(r.tokens)) for r in token_orc.token_table(odd(spark)).collect()}
    assert {(2, None, None), (3, 0, 0), (None, None, None)} <= rows and token_orc.token_table(odd(spark)).count() == 13
    assert token_orc.token_table(odd(spark).limit(0)).count() == 0


def test_exact_state_outlives_a_run(spark, tmp_path):
    new = lambda rows: documents(spark, [(i, t, "en") for i, t in rows], extra=False).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    run = lambda: {(r.doc_id, r.duplicate_of) for r in exact_stream.exact_dedup_path(spark, f"{tmp_path}/in", state=f"{tmp_path}/state").collect()}
    new([(5, "a"), (6, "b"), (7, "a"), (8, "c")])
    assert run() == {(7, 5)}
    read = len(list((tmp_path / "state/locators").glob("*.parquet")))
    new([(3, "b"), (9, "d"), (10, None)])
    assert run() == {(6, 3)}  # the old row is now the copy; "a" didn't come again
    new([(11, "a"), (12, "d")])
    assert run() == {(7, 5), (11, 5), (12, 9)}
    assert run() == set()
    # each file was read once: its rows have one locator
    at = spark.read.parquet(f"{tmp_path}/state/locators")
    assert read and at.count() == at.select("file", "row").distinct().count() == 8


def test_exact_reads_only_the_row_groups_of_hits(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    rows = [(k, f"text {k % 900}") for k in range(1000)]
    pq.write_table(pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]}), tmp_path / "d.parquet", row_group_size=70)
    got = {(r.doc_id, r.duplicate_of) for r in exact_stream.exact_dedup_path(spark, f"{tmp_path}/d.parquet").collect()}
    assert got == {(900 + k, k) for k in range(100)}
    want = spark.createDataFrame([(f"file://{tmp_path}/d.parquet", k) for k in (0, 69, 70, 500, 999)], "file string, row long")
    assert {r.row: r.text for r in exact_stream.fetch(want, 5).collect()} == {k: rows[k][1] for k in (0, 69, 70, 500, 999)}


def test_exact_hot_group(spark):
    rows = [(k, "the same text", "en") for k in range(3000)] + [(k, f"own {k}", "en") for k in range(3000, 6000)] + [(6000, "own 3000", "en")]
    got = {(r.doc_id, r.duplicate_of) for r in exact_stream.exact_dedup(documents(spark, rows, extra=False)).collect()}
    assert got == {(k, 0) for k in range(1, 3000)} | {(6000, 3000)}
