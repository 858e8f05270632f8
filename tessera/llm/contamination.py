"""Benchmark decontamination over training suffix arrays.

Every Arrow batch of training documents is cut into shards; a shard gets the
suffix array of all its word suffixes, every benchmark suffix is binary-searched
in it, and the hits are extended to the longest verbatim matches. Documents
never move: one narrow stage reads each text once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from .common import id_text, map_batches, table, trimmed

MIN_WORDS = 10
SHARD_BYTES = 1 << 22
#: Benchmark bytes that go to the executors at once; a larger benchmark takes several passes.
BENCHMARK_BYTES = 8 << 20
#: Words of one suffix array, and pairs of places that are looked at together.
SHARD_WORDS = 1 << 20
PAIRS = 1 << 20
_SCHEMA = "doc_id long, item_id long, match_words int, doc_word int, item_word int"


def suffix_array(h: np.ndarray, row: np.ndarray, depth: int) -> np.ndarray:
    """Word positions ordered by the words that follow, up to ``depth`` or more words; a row's end comes first.

    Prefix doubling in which only ranks that are still tied are sorted again.
    """
    n = len(h)
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.r_[True, s[1:] != s[:-1]] if n else np.zeros(0, bool)
    at = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, at, 0)) + 1
    span = 1
    tied = at
    while span < depth and n:
        alone = new[tied] & np.r_[new[np.minimum(tied[:-1] + 1, n - 1)], tied[-1] == n - 1 or new[min(tied[-1] + 1, n - 1)]]
        tied = tied[~alone]
        if not len(tied):
            break
        p = order[tied]
        q = np.minimum(p + span, n - 1)
        key = (rank[p] << 32) | np.where((p + span < n) & (row[q] == row[p]), rank[q], 0)
        o = np.argsort(key, kind="stable")
        order[tied] = p[o]
        key = key[o]
        new[tied] = np.r_[True, key[1:] != key[:-1]]
        starts = np.where(new[tied], tied, 0)
        rank[order[tied]] = np.maximum.accumulate(starts) + 1
        span *= 2
    return order


class Suffixes:
    """A shard: words and their suffix array."""

    def __init__(self, h: np.ndarray, row: np.ndarray, depth: int):
        self.h, self.row, self.n = h, row, len(h)
        self.order = suffix_array(h, row, depth)

    def word(self, p: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
        """(word d after p, whether it is in p's row)."""
        q = np.minimum(p + d, self.n - 1)
        return self.h[q], (p + d < self.n) & (self.row[q] == self.row[p])

    def _bound(self, lo, hi, v, d, upper):
        lo, hi = lo.copy(), hi.copy()
        while len(act := np.flatnonzero(lo < hi)):
            mid = (lo[act] + hi[act]) >> 1
            w, inside = self.word(self.order[mid], d)
            below = ~inside | (w < v[act]) | ((w == v[act]) if upper else False)
            lo[act] = np.where(below, mid + 1, lo[act])
            hi[act] = np.where(below, hi[act], mid)
        return lo

    def search(self, test: K.Words, q: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(test word, low, high): the range of the order in which the next ``least`` words are those of the test word, whole and in order."""
        first = self.h[self.order]
        v = test.hash[q]
        lo, hi = np.searchsorted(first, v, "left"), np.searchsorted(first, v, "right")
        for d in range(1, least):
            live = lo < hi
            q, lo, hi = q[live], lo[live], hi[live]
            if not len(q):
                break
            v = test.hash[q + d]
            lo, hi = self._bound(lo, hi, v, d, False), self._bound(lo, hi, v, d, True)
        live = lo < hi
        return q[live], lo[live], hi[live]


def _expand(lo: np.ndarray, size: np.ndarray) -> np.ndarray:
    """lo, lo + 1, ... of each range."""
    return np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)


def _before(words: K.Words, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether a word comes before in the row, its hash or 0)."""
    has = (at > 0) & (words.row[np.maximum(at - 1, 0)] == words.row[at])
    return has, np.where(has, words.hash[np.maximum(at - 1, 0)], np.uint64(0))


def _left_maximal(train: K.Words, base: int, shard: Suffixes, test: K.Words, q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(test words, low, high, training words): the pairs that can't be extended to the left, as ranges of the training words.

    The others are tails of these. Each range of equal suffixes is ordered by the word
    before, which leaves two ranges for a test word, on both sides of its own.
    """
    los, of = np.unique(lo, return_inverse=True)
    his = np.zeros(len(los), np.int64)
    his[of] = hi
    size = his - los
    at = shard.order[_expand(los, size)] + base
    begin = np.cumsum(size) - size
    has, word = _before(train, at)
    o = np.lexsort((word, has, np.repeat(np.arange(len(los)), size)))
    at, has, word = at[o], has[o], word[o]
    lo, hi = begin[of], begin[of] + size[of]
    mine, own = _before(test, q)

    def bound(upper: bool) -> np.ndarray:
        a, b = lo.copy(), hi.copy()
        while len(act := np.flatnonzero(a < b)):
            mid = (a[act] + b[act]) >> 1
            below = ~has[mid] | (word[mid] < own[act]) | ((word[mid] == own[act]) if upper else False)
            a[act] = np.where(below, mid + 1, a[act])
            b[act] = np.where(below, b[act], mid)
        return a

    left, right = np.where(mine, bound(False), hi), np.where(mine, bound(True), hi)
    q, lo, hi = np.r_[q, q], np.r_[lo, right], np.r_[left, hi]
    live = lo < hi
    return q[live], lo[live], hi[live], at


class _Extension:
    """How far the words after two places agree, by prefix sums of hashes and a binary search; built when first needed."""

    def __init__(self, train: K.Words, test: K.Words):
        n = max(len(train.hash), len(test.hash)) + 1
        power = np.full(n, K.U(0xD6E8FEB86659FD93), K.U)
        power[0] = 1
        self.power = np.multiply.accumulate(power)
        self.sums = [self._sums(w) for w in (train, test)]

    def _sums(self, words: K.Words) -> np.ndarray:
        out = np.zeros(len(words.hash) + 1, K.U)
        np.cumsum(words.hash * self.power[: len(words.hash)], out=out[1:])
        return out

    def length(self, p: np.ndarray, q: np.ndarray, least: int, most: np.ndarray) -> np.ndarray:
        """The largest number of words from ``least`` to ``most`` that agree after training word p and test word q."""
        a, b = self.sums
        lo, hi = np.full(len(p), least), most.copy()
        while len(act := np.flatnonzero(lo < hi)):
            n = (lo[act] + hi[act] + 1) >> 1
            i, j = p[act], q[act]
            same = (a[i + n] - a[i]) * self.power[j] == (b[j + n] - b[j]) * self.power[i]
            lo[act] = np.where(same, n, lo[act])
            hi[act] = np.where(same, hi[act], n - 1)
        return lo


def _longest(rows: list[np.ndarray]) -> np.ndarray:
    """Of (train row, test row, words, train word in row, test word in row) the longest of each pair of rows; ties: the earliest in the training text, then in the test text."""
    m = np.concatenate([np.zeros((0, 5), np.int64), *rows])
    m = m[np.lexsort((m[:, 4], m[:, 3], -m[:, 2], m[:, 1], m[:, 0]))]
    return m[np.r_[True, (m[1:, :2] != m[:-1, :2]).any(1)]] if len(m) else m


def longest_matches(train: K.Words, test: K.Words, least: int) -> np.ndarray:
    """Rows (train row, test row, words, train word in row, test word in row): the longest match of each pair of rows.

    Ties: the earliest in the training text, then in the test text. A long text is cut
    into shards that overlap by ``least`` - 1 words; matches are extended in the whole
    text. Pairs of places are gone through in blocks, so that memory doesn't grow with
    their number.
    """
    found: list[np.ndarray] = []
    starts = np.flatnonzero(K.grams(test, least)[1])
    extension = None
    last = len(train.hash) - least + 1
    for base in range(0, max(last, 0) if len(starts) else 0, SHARD_WORDS):
        end = min(base + SHARD_WORDS, last) + least - 1
        shard = Suffixes(train.hash[base:end], train.row[base:end], least)
        q, lo, hi = shard.search(test, starts, least)
        if not len(q):
            continue
        q, lo, hi, at = _left_maximal(train, base, shard, test, q, lo, hi)
        extension = extension or _Extension(train, test)
        done = np.cumsum(hi - lo)
        k = 0
        while k < len(q):
            z = max(k + 1, int(np.searchsorted(done, (done[k - 1] if k else 0) + PAIRS, "right")))
            size = hi[k:z] - lo[k:z]
            i, j = at[_expand(lo[k:z], size)], np.repeat(q[k:z], size)
            r, t = train.row[i].astype(np.int64), test.row[j].astype(np.int64)
            most = np.minimum(train.first[r + 1] - i, test.first[t + 1] - j)
            if found:  # pairs that can't beat the best of their rows
                best = found[0]
                key = best[:, 0] * len(test.first) + best[:, 1]
                b = best[np.minimum(np.searchsorted(key, r * len(test.first) + t), len(best) - 1)]
                x, y = i - train.first[r], j - test.first[t]
                less = (most < b[:, 2]) | ((most == b[:, 2]) & ((x > b[:, 3]) | ((x == b[:, 3]) & (y >= b[:, 4]))))
                live = ~((b[:, 0] == r) & (b[:, 1] == t) & less)
                i, j, r, t, most = i[live], j[live], r[live], t[live], most[live]
            n = extension.length(i, j, least, most)
            found = [_longest([*found, np.stack([r, t, n, i - train.first[r], j - test.first[t]], 1)])]
            k = z
    return _longest(found)


def _parts(benchmark: DataFrame, most: int):
    """The benchmark in parts of bounded size, each as an Arrow table."""
    sized = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    total = int(sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    n = max(1, -(-total // most))
    for k in range(n):
        yield (sized if n == 1 else sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)).toArrow()


def contamination(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, benchmark_bytes: int = BENCHMARK_BYTES, scripts: bool = False) -> DataFrame:
    """(doc_id, item_id, match_words, doc_word, item_word): the longest verbatim match of each affected document with each item.

    Words as in ``kernel``, by its ``scripts`` rule if asked (the query follows the
    SQL, which has the other rule); positions count words from 0. A match has at least
    ``min_words`` words; items and documents with fewer never match. Of equally
    long matches the earliest in the document, then in the item. Null texts
    match nothing, null ids are carried, repeated rows give repeated results.
    """
    out = None
    for part in _parts(benchmark, benchmark_bytes):
        raw, offsets = K.buffers(part["text"].combine_chunks())
        # nulls are filled in Arrow: NumPy has none and would make the ids floating-point
        ids, null = part["item_id"].fill_null(0).to_numpy(), part["item_id"].is_null().to_numpy(zero_copy_only=False)
        sent = docs.sparkSession.sparkContext.broadcast((raw.copy(), offsets.copy(), ids, null))

        def find(b: pa.RecordBatch, sent=sent) -> pa.RecordBatch | None:
            raw, offsets, ids, null = sent.value
            test = K.Words(raw, offsets, scripts)
            found = []
            body, off = K.buffers(b.column("text"))
            for k, r, o in K.chunks(body, off, SHARD_BYTES):
                m = longest_matches(K.Words(r, o, scripts), test, min_words)
                m[:, 0] += k
                found.append(m)
            m = np.concatenate(found)
            i32 = pa.int32()
            return pa.record_batch(
                [b.column("doc_id").take(pa.array(m[:, 0])), pa.array(ids[m[:, 1]], mask=null[m[:, 1]]), pa.array(m[:, 2], i32), pa.array(m[:, 3], i32), pa.array(m[:, 4], i32)],
                ["doc_id", "item_id", "match_words", "doc_word", "item_word"],
            )

        one = map_batches(id_text(docs), find, _SCHEMA)
        out = one if out is None else out.unionByName(one)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, benchmark_bytes: int = BENCHMARK_BYTES, scripts: bool = False) -> DataFrame:
    """The rows without a match; all columns. Every row is judged by its own text, where it lies."""
    at = docs.columns.index("text")
    for part in _parts(benchmark, benchmark_bytes):
        raw, offsets = K.buffers(part["text"].combine_chunks())
        sent = docs.sparkSession.sparkContext.broadcast((raw.copy(), offsets.copy()))

        def sift(batches, sent=sent):
            test = K.Words(*sent.value, scripts)
            for b in batches:
                if not b.num_rows:
                    continue
                keep = np.ones(b.num_rows, bool)
                for k, r, o in K.chunks(*K.buffers(b.column(at)), SHARD_BYTES):
                    keep[longest_matches(K.Words(r, o, scripts), test, min_words)[:, 0] + k] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(trimmed(sift), docs.schema)
    return docs


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = {
    "op9_decontamination": """
WITH dw AS (
  SELECT doc_id, generate_subscripts(w, 1) - 1 AS p, unnest(w) AS h FROM (
    SELECT doc_id, list_transform(regexp_extract_all(text, '[0-9A-Za-z\\x{80}-\\x{10ffff}]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents)
), bw AS (
  SELECT item_id, generate_subscripts(w, 1) - 1 AS q, unnest(w) AS h FROM (
    SELECT item_id, list_transform(regexp_extract_all(text, '[0-9A-Za-z\\x{80}-\\x{10ffff}]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM benchmark)
), dg AS (
  SELECT doc_id, p, string_agg(h, ' ') OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS g, count(*) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS n FROM dw
), bg AS (
  SELECT item_id, q, string_agg(h, ' ') OVER (PARTITION BY item_id ORDER BY q ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS g, count(*) OVER (PARTITION BY item_id ORDER BY q ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS n FROM bw
), m AS (
  SELECT doc_id, item_id, p, q, p - q AS diag FROM dg JOIN bg USING (g) WHERE dg.n = 10 AND bg.n = 10
), isl AS (
  SELECT *, p - row_number() OVER (PARTITION BY doc_id, item_id, diag ORDER BY p) AS isl FROM m
), runs AS (
  SELECT doc_id, item_id, count(*) + 9 AS words, min(p) AS p, min(q) AS q FROM isl GROUP BY doc_id, item_id, diag, isl
)
SELECT doc_id, item_id, words::INTEGER AS match_words, p::INTEGER AS doc_word, q::INTEGER AS item_word FROM runs
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY words DESC, p, q) = 1
"""
}
