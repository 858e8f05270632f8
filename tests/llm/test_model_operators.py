"""Operators that SQL can't express: signatures, classifiers, filters, cuts and the pipeline."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tessera.llm import bagminhash, contamination, kernel, language, mincut_html, mixing, queries, token_orc
from tessera.llm.common import written

from .helpers import documents, near_groups, odd, weighted_jaccard, words


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    for wx, wy in (([1] * 40, [1] * 20 + [0] * 20), ([8, 1, 3, 5, 2, 13], [2, 4, 3, 1, 9, 13]), ([100, 3], [40, 9]), ([1], [1])):
        x, y = np.array(wx), np.array(wy)
        want = np.minimum(x, y).sum() / np.maximum(x, y).sum()
        same = []
        for _ in range(60):
            g = rng.integers(1, 2**63, len(x), dtype=np.uint64)
            row = np.r_[np.zeros(len(x), np.int64), np.ones((y > 0).sum(), np.int64)]
            sig = bagminhash.signatures(row, np.r_[g, g[y > 0]], np.r_[x, y[y > 0]], 2, 64)
            same.append((sig[0] == sig[1]).mean())
        assert np.mean(same) == pytest.approx(want, abs=0.03)


def test_near_duplicates_against_all_pairs(spark, sf, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = near_groups(texts, bagminhash.THRESHOLD)
    got = {r.doc_id: r.group_id for r in queries.QUERIES["op10_minhash_near_dedup"](spark, sf).collect()}
    assert want and set(got) <= set(want)  # verified: none that isn't a near copy
    assert len(got) >= 0.9 * len(want)
    assert sum(got[i] == want[i] for i in got) >= 0.9 * len(got)
    left = {r.doc_id for r in bagminhash.drop_near_duplicates(docs).collect()}
    assert left == set(texts) - {i for i, g in got.items() if i != g}


def test_near_duplicates_odd(spark):
    df = odd(spark)
    got = {r.doc_id: r.group_id for r in bagminhash.near_duplicates(df).collect()}
    assert got == {4: 4, 5: 4, 8: 8, 9: 8}
    kept = bagminhash.drop_near_duplicates(df)
    assert kept.columns == df.columns and kept.count() == 11
    assert bagminhash.near_duplicates(df.limit(0)).count() == 0 and bagminhash.drop_near_duplicates(df.limit(0)).count() == 0


def test_near_duplicates_with_several_texts_of_an_id(spark):
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(1, base + " one", "en"), (2, base + " two", "en"), (2, "quite another text of the same id", "en"), (2, base + " two", "en"), (None, base + " one", "en")]
    for order in (rows, rows[::-1]):
        df = documents(spark, order)
        bags = bagminhash.sketch(df.where("doc_id = 2").selectExpr("doc_id", "text", "xxhash64(text) AS t")).collect()
        standing = min(bags, key=lambda r: (r.bag1, r.bag2)).n
        left = sorted(str((r.doc_id, r.text[-3:])) for r in bagminhash.drop_near_duplicates(df).collect())
        other = [] if standing == 61 - 1 else ["(2, 'two')"] * 2
        assert left == sorted(["(1, 'one')", "(2, ' id')", "(None, 'one')", *other])


def test_a_bucket_of_many_copies(spark):
    rnd = random.Random(8)
    base = [f"w{k}" for k in range(80)]
    rows = [(k, " ".join(base[:-1] + [f"end{k}"]), "en") for k in range(300)] + [(1000 + k, " ".join(rnd.choice("abcdefgh") + str(rnd.randrange(999)) for _ in range(50)), "en") for k in range(50)]
    got = {r.doc_id: r.group_id for r in bagminhash.near_duplicates(documents(spark, rows)).collect()}
    assert got == dict.fromkeys(range(300), 0)


def test_components(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 101), (103, 101), (7, 7)]
    got = {r.node: r.root for r in bagminhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == dict.fromkeys(range(1, 61), 0) | {101: 100, 103: 100}
    assert bagminhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_language_held_out(spark, docs):
    half = docs.where("doc_id % 2 = 0")
    rows = language.identify(docs.where("doc_id % 2 = 1"), language.fit(half)).join(docs.select("doc_id", "lang"), "doc_id").where("grams >= 40").collect()
    assert len(rows) > 50
    right = sum(r.language == r.lang for r in rows if r.accepted) / sum(r.accepted for r in rows)
    assert right >= 0.98
    assert sum(r.accepted for r in rows) / len(rows) >= 0.95
    rnd = random.Random(1)
    noise = documents(spark, [(k, "".join(rnd.choice("bcdfghjklmnpqrstvwxzъыщ") for _ in range(400)), None) for k in range(20)])
    assert not any(r.accepted for r in language.identify(noise, language.fit(docs)).collect())


def test_language_filter_contains_every_gram():
    f = language.Filter([f"l{k}" for k in range(70)], slots=1 << 12)
    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 2**63, 200, dtype=np.uint64) for _ in range(70)]
    for k, g in enumerate(sets):
        f.add(2 * k + k % 2, g)
    for k, g in enumerate(sets):
        assert f.bit(f.containing(g), 2 * k + k % 2).all()
    other = rng.integers(0, 2**63, 20_000, dtype=np.uint64)
    seen = [np.mean(f.bit(f.containing(other), k)) for k in range(f.sets)]
    assert np.abs(np.array(seen) - f.rates()).max() < 0.01


def test_language_shares_against_exact_sets(spark, docs):
    """Each document's share of n-grams that the sampled texts of the other half have, by sets; at most the filter's false positives apart."""
    fold = lambda t: [32, *(int(language.FOLD[b]) for b in t.encode()), 32]
    grams = lambda b: [tuple(b[k : k + 4]) for k in range(len(b) - 3) if (b[k], b[k + 1]) != (32, 32)]
    rows = docs.where("text IS NOT NULL").select("doc_id", "text", "lang", language.half_of(docs["doc_id"]).alias("half")).collect()
    sets = {}
    for r in rows:  # the table has fewer rows a language than the sample
        if r.lang is not None:
            sets.setdefault((r.lang, r.half), set()).update(grams(fold(r.text)))
    languages = sorted({x for x, _ in sets})
    got = {r.doc_id: r for r in language.identify(docs, language.fit(docs)).collect()}
    for r in rows:
        g = grams(fold(r.text))
        share = [sum(x in sets.get((lang, 1 - r.half), ()) for x in g) / max(len(g), 1) for lang in languages]
        assert got[r.doc_id].grams == len(g) and got[r.doc_id].share == pytest.approx(max(share), abs=0.02)


def test_languages_beyond_64(spark):
    rnd = random.Random(3)
    words_of = {f"l{k:02}": ["".join(rnd.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(12)] for k in range(80)}
    rows = [(k * 10 + j, " ".join(rnd.choice(w) for _ in range(60)), lang) for k, (lang, w) in enumerate(words_of.items()) for j in range(10)]
    df = documents(spark, rows)
    found = language.identify(df, language.fit(df)).collect()
    assert {r.doc_id: r.language for r in found} == {i: lang for i, _, lang in rows}


def test_language_odd(spark, docs):
    df = odd(spark)
    rows = language.identify(df, language.fit(docs)).collect()
    assert len(rows) == 13
    for r in rows:
        if r.doc_id in (2, 3, 6, 7):
            assert r.language is None and r.share == 0 and not r.accepted
    kept = language.accepted(df, language.fit(docs))
    assert kept.columns == df.columns and kept.count() == sum(r.accepted for r in rows)
    none = language.fit(df.limit(0))
    assert not any(r.accepted for r in language.identify(df, none).collect()) and language.accepted(df, none).count() == 0
    assert language.identify(df.limit(0), none).count() == 0
    assert language.fit(df).languages == ["de", "en"]


def test_mixing_meets_targets(spark, sf, docs):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = queries.QUERIES["op6_mixing_rates"](spark, sf).collect()
    n = np.array([r.tokens for r in rows], float)
    p = np.array([[r[f"p_{d}"] for d in mixing.DOMAINS] for r in rows])
    rate = np.array([r.rate for r in rows])
    goal = np.array([mixing.TARGETS[d] for d in mixing.DOMAINS]) * n.sum()
    assert len(rows) == docs.count() and (rate >= 0).all() and np.allclose(p.sum(1), 1, atol=1e-6)
    assert [r.tokens for r in rows] == [len(words(t.text)) for t in docs.collect()]
    got = (rate * n) @ p
    # against plain projected gradient over the same objective, run long
    m = (p * n[:, None]).T @ p
    w = 1 / np.diag(m)
    x, step = np.ones(len(rows)), 1 / np.linalg.eigvalsh(np.diag(w**0.5) @ m @ np.diag(w**0.5)).max()
    for _ in range(20_000):
        x = np.maximum(x - step * p @ (w * ((x * n) @ p - goal)), 0)
    cost = lambda r: float((w * ((r * n) @ p - goal) ** 2).sum())
    assert cost(rate) <= cost(x) + 1e-4 * cost(np.zeros(len(rows)))
    short = np.abs(got - goal) / goal.sum()
    assert short.max() < 0.02
    again = mixing.mixed(docs, labels).groupBy("doc_id").count().collect()
    of = {r.doc_id: r.rate for r in rows}
    assert all(int(of[r.doc_id]) <= r["count"] <= int(of[r.doc_id]) + 1 for r in again)
    assert sum(r["count"] for r in again) == pytest.approx(rate.sum(), rel=0.15)


def test_mixing_meets_targets_in_bpe_tokens(spark, sf, docs, monkeypatch):
    enc = token_orc.encoder()
    n_of = {r.doc_id: len(enc.encode_ordinary(r.text)) for r in docs.collect()}
    rows = queries.QUERIES["op6_mixing_rates"](spark, sf).collect()
    assert {r.doc_id: r.bpe_tokens for r in rows} == n_of
    n = np.array([r.bpe_tokens for r in rows], float)
    p = np.array([[r[f"p_{d}"] for d in mixing.DOMAINS] for r in rows])
    rate = np.array([r.bpe_rate for r in rows])
    goal = np.array([mixing.TARGETS[d] for d in mixing.DOMAINS])
    got = (rate * n) @ p / n.sum()
    assert (np.abs(got - goal) < 0.02 * np.maximum(goal, 0.05)).all()
    # the pipeline takes documents by these rates
    taken = {r.doc_id: r["count"] for r in corpus_pipeline.mix(spark, docs, sf).groupBy("doc_id").count().collect()}
    assert all(int(r.bpe_rate) <= taken.get(r.doc_id, 0) <= int(r.bpe_rate) + 1 for r in rows)
    asked = {}
    monkeypatch.setattr(mixing, "mixed", lambda *a, **kw: asked.update(kw))
    corpus_pipeline.mix(spark, docs, sf)
    assert asked == {"count": "bpe_tokens"}


def test_mixing_weighs_long_runs_by_their_bpe_tokens(spark):
    rows = documents(spark, [(1, "中文字" * 200, "zh"), (2, "one two", "en"), (3, "#" * 90, "en"), (4, None, "en"), (5, "", "en")])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    enc = token_orc.encoder()
    got = {r.doc_id: (r.tokens, r.bpe_tokens) for r in mixing.mixing_rates(rows, labels).collect()}
    assert got == {1: (1, len(enc.encode_ordinary("中文字" * 200))), 2: (2, len(enc.encode_ordinary("one two"))), 3: (0, len(enc.encode_ordinary("#" * 90))), 4: (0, 0), 5: (0, 0)}


def test_mixing_classifier_held_out(spark):
    big = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = mixing.fit(big, labels.where("doc_id % 3 <> 0"))
    rows = mixing.posteriors(big, model).join(labels.where("doc_id % 3 = 0"), "doc_id").collect()
    truth = [2 if r.toxic == 1 else 0 if r.quality == 1 else 1 for r in rows]
    found = [int(np.argmax([r[f"p_{d}"] for d in mixing.DOMAINS])) for r in rows]
    assert np.mean(np.array(truth) == found) >= 0.85


def test_mixing_odd(spark, sf):
    df = odd(spark)
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (8, None, 1), (None, 1, 1), (9, 0, 1), (77, 1, 0)], "doc_id long, quality int, toxic int")
    for lab in (labels, labels.limit(0)):
        rows = mixing.mixing_rates(df, lab).collect()
        assert len(rows) == 13 and all(r.rate >= 0 for r in rows)
        assert all(r.rate == 1 and r.tokens == 0 for r in rows if r.doc_id in (2, 3, 6, 7))
        out = mixing.mixed(df, lab)
        assert out.columns == df.columns and out.where("doc_id = 2").count() == 1
    assert mixing.mixing_rates(df.limit(0), labels).count() == 0 and mixing.mixed(df.limit(0), labels).count() == 0
    assert {r.rate for r in mixing.mixing_rates(df, labels, {}).collect()} == {1.0}


def test_min_cut_against_all_labellings():
    rnd = random.Random(3)
    for _ in range(300):
        n = rnd.randrange(1, 9)
        cost = [rnd.choice([-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 3.0]) for _ in range(n)]
        edges = [(a, b, rnd.choice([0.5, 1.0, 2.0])) for a, b in itertools.combinations(range(n), 2) if rnd.random() < 0.5]

        def value(side, cost=cost, edges=edges):
            return sum(max(c, 0) * (not s) + max(-c, 0) * s for c, s in zip(cost, side, strict=True)) + sum(w for a, b, w in edges if side[a] != side[b])

        least = min(value(s) for s in itertools.product([False, True], repeat=n))
        side = mincut_html.min_cut(cost, edges)
        assert value(side) == pytest.approx(least)
        smallest = min((s for s in itertools.product([False, True], repeat=n) if value(s) <= least + 1e-9), key=sum)
        assert sum(side) == sum(smallest)


PAGE = """<html><head><title>T</title><script>var x="<p>no</p>";</script></head><body><nav><ul><li><a href=/>Home</a></li><li><a href=/b>Shop</a></li></ul></nav>
<article><h1>A heading of it</h1><p>This is the first paragraph, with enough words to read &amp; keep. It goes on, as text does.</p><p>Second one: also long enough to be told from a menu, isn't it?</p></article>
<aside><a href=x>Buy now</a></aside><footer>Imprint <a href=z>privacy</a></footer></body></html>"""


def test_html(spark, sf):
    weights = mincut_html.fit(spark.read.parquet(f"{sf}/pages.parquet"))
    text, n, kept = mincut_html.main_text(PAGE, weights)
    assert "first paragraph, with enough words to read & keep" in text and "Second one" in text
    assert not any(x in text for x in ("Home", "Buy", "privacy", "var x"))
    assert kept < n
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, None), (None, "u", "", "x"), (3, "u", "<p>" * 3000 + "deep", "x"), (4, "u", "<p>word word</p>" * 20_000, "x"), (5, "u", "< & <a <<p>", "x")], "page_id long, url string, html string, text string")
    rows = sorted(mincut_html.extract(pages, weights).collect(), key=str)
    assert len(rows) == 7
    by = {r.page_id: r for r in rows}
    assert by[2].text is None and by[2].n_blocks == 0 and by[None].text == "" and by[4].n_blocks == 20_000
    assert mincut_html.extract(pages.limit(0), weights).count() == 0
    assert (mincut_html.fit(pages.limit(0)) == mincut_html.DEFAULT).all()
    whole = queries.QUERIES["op8_html_mincut"](spark, sf)
    assert whole.count() == spark.read.parquet(f"{sf}/pages.parquet").count()


def test_html_agrees_with_semantic_elements_held_out(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    weights = mincut_html.fit(pages.where("page_id % 2 = 0"))
    right = total = 0
    for r in pages.where("page_id % 2 = 1 AND html IS NOT NULL").collect():
        bs = mincut_html.blocks(r.html)
        if not bs:
            continue
        odds = np.clip(mincut_html.features(bs) @ weights, -6, 6)  # without the container's own odds
        side = mincut_html.min_cut(odds.tolist(), mincut_html.graph(bs))
        for b, s in zip(bs, side, strict=True):
            if b[4]:
                total += 1
                right += s == (b[4] > 0)
    assert total > 200 and right / total >= 0.85


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="<>/pdiva ='\"&;!-x\n", max_size=120))
def test_html_never_breaks(page):
    text, n, kept = mincut_html.main_text(page, mincut_html.DEFAULT)
    assert 0 <= kept <= n and bool(text) == bool(kept)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB1 .é\n中", max_size=40), max_size=6))
def test_kernel_words(texts):
    import pyarrow as pa

    raw, offsets = kernel.buffers(pa.array(texts, pa.string()))
    w = kernel.Words(raw, offsets)
    got = [[bytes(raw[a:b]).decode().lower() for a, b in zip(w.start[x:y], w.end[x:y], strict=True)] for x, y in zip(w.first[:-1], w.first[1:], strict=True)]
    assert [[x.replace("É", "é") for x in g] for g in got] == [words(t) for t in texts]
    named = {}
    for h, word in zip(w.hash.tolist(), [x for g in got for x in g], strict=True):
        assert named.setdefault(word, h) == h
    assert len(set(named.values())) == len(named)


def test_kernel_words_by_script():
    import pyarrow as pa

    texts = ["中文，abc def。", "", "ab中c é—x\u3000日本ー", "ไทย ok", "🙂 né 12", "中", "文", "«Ça» va…", None, "𠀀𠀁"]
    raw, offsets = kernel.buffers(pa.array(texts, pa.string()))
    w = kernel.Words(raw, offsets, scripts=True)
    got = [[bytes(raw[a:b]).decode() for a, b in zip(w.start[x:y], w.end[x:y], strict=True)] for x, y in zip(w.first[:-1], w.first[1:], strict=True)]
    assert got == [["中", "文", "abc", "def"], [], ["ab", "中", "c", "é", "x", "日", "本", "ー"], ["ไ", "ท", "ย", "ok"], ["🙂", "né", "12"], ["中"], ["文"], ["Ça", "va"], [], ["𠀀", "𠀁"]]
    assert w.hash[0] == w.hash[w.first[5]] != w.hash[w.first[6]]


def test_scripts_without_spaces(spark, sf):
    rnd = random.Random(6)
    say = lambda n: "".join(chr(rnd.randrange(0x4E00, 0x9FA5)) for _ in range(n))
    item, text = say(40), say(300)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    df = documents(spark, [(1, say(30) + item + say(30), "zh"), (2, text, "zh"), (3, text[:150] + "。" + say(1) + text[150:], "zh"), (4, say(300), "zh")])
    assert [tuple(r) for r in contamination.contamination(df, bench, scripts=True).collect()] == [(1, 1, 40, 30, 0)]
    assert {r.doc_id for r in contamination.clean(df, bench, scripts=True).collect()} == {2, 3, 4}
    assert {r.doc_id: r.group_id for r in bagminhash.near_duplicates(df).collect()} == {2: 2, 3: 2}
    asked = {}
    with pytest.MonkeyPatch.context() as m:
        m.setattr(contamination, "clean", lambda *a, **kw: asked.update(kw))
        corpus_pipeline.decontaminate(spark, df, sf)
    assert asked == {"scripts": True}


def test_pipeline_stages(spark, sf, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "mix", "tokenize"]
    now = docs
    kept = {"": {r.doc_id: r.text for r in docs.collect()}}
    for name, stage in corpus_pipeline.STAGES[:4]:
        now = stage(spark, now, sf)
        now = written(now, f"test-{name}")
        assert now.columns == docs.columns
        kept[name] = {r.doc_id: r.text for r in now.collect()}
        assert kept[name].items() <= kept[""].items()
    good = {r.doc_id for r in language.identify(docs, language.fit(docs)).collect() if r.accepted}
    assert set(kept["language_id"]) == good and len(good) > 0.9 * len(kept[""])
    groups = near_groups(kept["language_id"], bagminhash.THRESHOLD)
    gone = set(kept["language_id"]) - set(kept["near_dedup"])
    assert gone <= {i for i, g in groups.items() if i != g} and len(gone) >= 0.9 * sum(i != g for i, g in groups.items())
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    hit = {r.doc_id for r in contamination.contamination(docs, bench).collect()}
    assert set(kept["decontaminate"]) == set(kept["near_dedup"]) - hit
    rows = corpus_pipeline.run(spark, sf).collect()
    enc = token_orc.encoder()
    final = {r.doc_id: enc.decode(r.tokens) for r in rows}
    assert final == kept["mix"]
    assert len(rows) == now.count()


def test_pipeline_survives_odd_rows(spark, sf):
    now = odd(spark)
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf)
    enc = token_orc.encoder()
    found = {(r.doc_id, enc.decode(r.tokens)) for r in now.collect()}
    # only rows of the input are left, and none that a stage must reject: null, empty, without letters
    assert now.columns == ["doc_id", "n_tokens", "tokens"]
    assert found <= {(r.doc_id, r.text) for r in odd(spark).where("text IS NOT NULL").collect()}
    assert not {i for i, _ in found} & {2, 3, 6, 7} and 5 not in {i for i, _ in found}


def test_no_local_checkpoint_nor_driver_sized_state(spark):
    import pathlib

    root = pathlib.Path(queries.__file__).parent
    assert not any("localCheckpoint" in p.read_text() for p in root.glob("*.py"))
