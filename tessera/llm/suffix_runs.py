"""Repeated passages by a distributed, common-prefix-aware merge sort of suffixes.

1. Which suffixes can repeat: of every ``min_words`` consecutive words the
   smallest of their 20-word hashes is an anchor. Equal passages pick equal
   anchors, so a passage that repeats has an anchor that repeats; suffixes
   away from such anchors are left out (an exact test, none is missed). An anchor that
   repeats within a batch is settled there; one row of it stands for the batch.
2. Runs: texts are bucketed by their hash, a text that has copies once (the copies
   are named at the end); a bucket sorts its suffixes over the
   alphabet of ten-word blocks, five symbols deep, and sends each range of the
   order as a front-coded run of distinct suffixes, each with its first place alone:
   shared prefix length, then the other symbols. The places themselves stay with the bucket.
3. Merge: a range's runs meet in a loser tree that keeps every run head's common
   prefix with the last output. Heads that differ in it are told apart by it
   alone, equal ones are compared from there on; known prefixes never again. A
   suffix that many documents hold is one entry a bucket, however often it occurs.
4. Each bucket learns which of its suffixes repeat, and where first; equal suffixes
   are repeated windows, and a text's overlapping ones are joined.

Suffixes are compared by their first 50 words (five 32-bit block hashes), as windows
of that length decide; beyond these the order is not defined.

``without_repeats`` removes: of each window every occurrence but the first goes.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import kernel as K
from .common import LAST, fresh, id_text, map_batches, table, with_keys, written

MIN_WORDS = 50
ANCHOR = 20
BLOCK = 10
DEPTH = MIN_WORDS // BLOCK
#: Text of one bucket; the number of buckets grows with the input.
BUCKET_BYTES = 12 << 20
_SPREAD = MIN_WORDS - ANCHOR
#: Texts that a task remembers so as to send copies but once.
SEEN = 1 << 18


def anchors(words: K.Words) -> tuple[np.ndarray, np.ndarray]:
    """(word position, hash) of the anchors: the leftmost smallest 20-word hash of every window of 50 words."""
    g, _ = K.grams(words, ANCHOR)
    n = len(words.hash) - MIN_WORDS + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, span = np.arange(len(g)), 1
    while span * 2 <= _SPREAD + 1:
        a, b = best[:-span], best[span:]
        best = np.where(g[a] <= g[b], a, b)
        span *= 2
    rest = _SPREAD + 1 - span
    if rest:
        a, b = best[: len(best) - rest], best[rest:]
        best = np.where(g[a] <= g[b], a, b)
    at = np.unique(best[:n][words.row[:n] == words.row[MIN_WORDS - 1 :]])
    return at, g[at]


def pack(*arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    for a in arrays:
        np.save(out, a, allow_pickle=False)
    return out.getvalue()


def unpack(blob: bytes, n: int) -> list[np.ndarray]:
    f = io.BytesIO(blob)
    return [np.load(f, allow_pickle=False) for _ in range(n)]


def run_of(symbols: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, ...]:
    """A sorted run: (distinct keys, common prefix with the key before, places of each, order of the places: by key, doc, pos)."""
    s = symbols.astype(np.uint64)
    pairs = [s[:, k] << np.uint64(32) | (s[:, k + 1] if k + 1 < s.shape[1] else np.uint64(0)) for k in range(0, s.shape[1], 2)]
    o = np.lexsort((pos, doc, *pairs[::-1]))
    symbols = symbols[o]
    same = symbols[1:] == symbols[:-1]
    lcp = np.r_[0, np.minimum.accumulate(same, axis=1).sum(1)].astype(np.uint8)[: len(symbols)]
    new = np.flatnonzero(lcp < symbols.shape[1])
    return symbols[new], lcp[new], np.diff(np.r_[new, len(symbols)]).astype(np.int32), o


def front_code(keys: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """The symbols that aren't shared with the key before."""
    return keys[np.arange(keys.shape[1]) >= lcp[:, None]]


def front_decode(lcp: np.ndarray, rest: np.ndarray, depth: int) -> np.ndarray:
    own = np.arange(depth) >= lcp[:, None]
    keys = np.zeros(own.shape, np.uint32)
    keys[own] = rest
    for k in range(depth):
        keys[:, k] = keys[np.maximum.accumulate(np.where(own[:, k], np.arange(len(own)), 0)), k]
    return keys


def merge(runs: list[tuple[list[list[int]], list[int]]]) -> tuple[list[int], list[int]]:
    """(run, common prefix with the output before) of every output of a loser tree over (keys, common prefixes) runs.

    A run's outputs come in its own order. An exhausted run's prefix is -1, so it
    loses to any other.
    """
    k = len(runs)
    heads, common, place = [], [], [0] * k
    for keys, _ in runs:
        heads.append(keys[0] if keys else None)
        common.append(0 if keys else -1)
    depth = next((len(h) for h in heads if h), 0)
    tree = [-1] * k  # losers; tree[0] is unused

    def game(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's common prefix becomes that with the winner."""
        x, y = common[a], common[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        p, q = heads[a], heads[b]
        while x < depth and p[x] == q[x]:
            x += 1
        if x == depth or p[x] < q[x]:
            common[b] = x
            return a, b
        common[a] = x
        return b, a

    up = [0] * (2 * k)
    for r in range(k):
        up[k + r] = r
    for node in range(k - 1, 0, -1):
        up[node], tree[node] = game(up[2 * node], up[2 * node + 1])
    w = up[1] if k > 1 else 0
    out_run, out_lcp = [], []
    while k and common[w] >= 0:
        out_run.append(w)
        out_lcp.append(common[w])
        keys, lcps = runs[w]
        i = place[w] = place[w] + 1
        if i < len(keys):
            heads[w], common[w] = keys[i], lcps[i]
        else:
            common[w] = -1
        node = (k + w) >> 1
        while node:
            b = tree[node]
            x, y = common[w], common[b]
            if x == y and x >= 0:
                p, q = heads[w], heads[b]
                while x < depth and p[x] == q[x]:
                    x += 1
                if x == depth or p[x] < q[x]:
                    common[b] = x
                else:
                    common[w] = x
                    tree[node] = w
                    w = b
            elif x < y:
                tree[node] = w
                w = b
            node >>= 1
    return out_run, out_lcp


def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (.., t, t2, ..) of a partition without those whose text came before; it remembers so many texts, then starts afresh."""
    seen: set[tuple[int, int]] = set()
    for b in batches:
        if len(seen) > SEEN:
            seen.clear()
        keep = np.zeros(b.num_rows, bool)
        for k, key in enumerate(zip(b.column("t").to_pylist(), b.column("t2").to_pylist(), strict=True)):
            if key not in seen:
                seen.add(key)
                keep[k] = True
        yield b.filter(pa.array(keep))


def find_anchors(b: pa.RecordBatch) -> pa.RecordBatch:
    """(h, t, pos, sure, spread) of a batch's anchors.

    Those whose hash has several places in the batch are sure to repeat: each goes its own way (``spread``), and
    one more row stands for all of them where the hash is compared with other batches.
    """
    t = b.column("t").to_numpy()
    hs, ts, ps = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)]
    for k, r, o in K.chunks(*K.buffers(b.column("text"))):
        w = K.Words(r, o)
        at, h = anchors(w)
        row = w.row[at]
        hs.append(h.view(np.int64))
        ts.append(t[row + k])
        ps.append((at - w.first[row]).astype(np.int32))
    h, t, pos = np.concatenate(hs), np.concatenate(ts), np.concatenate(ps)
    o = np.lexsort((pos, t, h))
    h, t, pos = h[o], t[o], pos[o]
    new = np.r_[True, (h[1:] != h[:-1]) | (t[1:] != t[:-1]) | (pos[1:] != pos[:-1])] if len(h) else np.zeros(0, bool)
    h, t, pos = h[new], t[new], pos[new]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    size = np.diff(np.r_[first, len(h)])
    sure = np.repeat(size > 1, size)
    one = first[size > 1]
    spread = np.where(sure, K.mix(t.view(np.uint64) + pos.astype(np.uint64)).view(np.int64), 0)
    columns = (np.r_[h, h[one]], np.r_[t, t[one]], np.r_[pos, pos[one]], np.r_[sure, np.zeros(len(one), bool)], np.r_[spread, np.zeros(len(one), np.int64)])
    return pa.record_batch([pa.array(x) for x in columns], ["h", "t", "pos", "sure", "spread"])


def merge_range(runs: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """(bucket, verdict) of each run of a range: which of its suffixes occur more than once, and where first."""
    lists, parts = [], []
    for blob in runs:
        lcp, rest, multi, doc, pos, (bucket, base) = unpack(blob, 6)
        lists.append((front_decode(lcp, rest, DEPTH).tolist(), lcp.tolist()))
        parts.append((multi, doc, pos, int(bucket), int(base)))
    order, common = (np.array(x, np.int64) for x in merge(lists))
    if not len(order):
        return
    # an output is its run's next key
    nth = np.empty(len(order), np.int64)
    o = np.argsort(order, kind="stable")
    nth[o] = np.arange(len(order))
    multi, doc, pos = (np.concatenate([p[i] for p in parts])[nth] for i in range(3))
    key = np.cumsum(common < DEPTH) - 1
    again = (np.bincount(key) > 1) | (np.bincount(key, multi) > 0)
    o = np.lexsort((pos, doc, key))
    first = o[np.flatnonzero(np.r_[True, np.diff(key[o]) != 0])]
    keep = again[key]
    start = np.cumsum([0, *(len(p[0]) for p in parts)])
    for r in range(len(parts)):
        mine = np.flatnonzero(keep & (order == r))
        if len(mine):
            f = first[key[mine]]
            yield parts[r][3], pack((nth[mine] - start[r] + parts[r][4]).astype(np.int32), doc[f], pos[f])


def bucket_spans(home: bytes, verdicts: list[bytes], removable: bool) -> tuple[np.ndarray, ...]:
    """(doc, start, end, first, t, t2, copies) of a bucket's texts; a text with copies also has its whole, with its hash and number of copies (0: a span of one text)."""
    count, text, pos, doc, size, t, t2, copies = unpack(home, 8)
    known = np.zeros(len(count), bool)
    least, place = np.zeros(len(count), np.int64), np.zeros(len(count), np.int32)
    for blob in verdicts:
        key, d, p = unpack(blob, 3)
        known[key], least[key], place[key] = True, d, p
    key = np.repeat(np.arange(len(count)), count)
    keep = known[key]
    if removable:
        keep &= (doc[text] != least[key]) | (pos != place[key])
    text, pos, first = text[keep], pos[keep].astype(np.int64), least[key[keep]]
    o = np.lexsort((pos, text))
    text, pos, first = text[o], pos[o], first[o]
    new = np.flatnonzero(np.r_[True, (np.diff(text) != 0) | (np.diff(pos) >= MIN_WORDS)]) if len(text) else np.zeros(0, np.int64)
    last = np.r_[new[1:], len(text)] - 1
    whole = np.flatnonzero((copies > 1) & (size >= MIN_WORDS))
    lowest = doc.copy()
    np.minimum.at(lowest, text, first)
    # the whole takes the place of its own spans, but for the copy that stays
    own = new if removable else new[~np.isin(text[new], whole)]
    end = pos[last[np.isin(new, own)]] + MIN_WORDS
    zero = np.zeros(len(own), np.int64)
    first_of = np.minimum.reduceat(first, new)[np.isin(new, own)] if len(new) else first
    spans = doc[text[own]], pos[own], end, first_of, zero, zero, zero
    wholes = doc[whole], np.zeros(len(whole), np.int64), size[whole], lowest[whole], t[whole], t2[whole], copies[whole]
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(spans, wholes, strict=True))


def repeated_passages(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, removable: bool = False) -> DataFrame:
    """(doc_id, start_word, end_word, first_doc_id): every passage of 50 words or more that occurs more than once.

    Words as in ``kernel``, counted from 0, end exclusive. Spans are unions of
    overlapping 50-word windows that occur elsewhere, in another document or in
    the same; every occurrence is returned; first_doc_id is the smallest document among
    the occurrences of the span's windows. These are reports: a span can hold words
    whose only copy it is one of, so ``doc_id > first_doc_id`` is no rule for removal.

    With ``removable``, for doc_ids that are unique and not null, windows that are the
    first occurrence (by doc_id, then place) are left out before windows are joined,
    and of equal texts the one of the smallest doc_id; the spans can all be removed.
    Each word in one has a copy at an earlier place, so a copy of each stays. Texts of fewer words, null and empty texts
    have none. Rows with a null doc_id serve as occurrences alone: nothing could name
    their spans, so none is returned. A repeated row is a copy; rows of one doc_id with other texts are
    texts of their own, whose spans are all returned under it.
    """
    texts = id_text(docs).where("text IS NOT NULL").select(F.coalesce("doc_id", F.lit(LAST)).alias("doc_id"), "text", F.xxhash64("text").alias("t"), F.xxhash64(F.lit("second"), "text").alias("t2"))
    named = written(texts.select("doc_id", "t", "t2", F.octet_length("text").alias("size")), "texts")
    total, size = (int(x or 0) for x in named.agg(F.count(F.lit(1)), F.sum("size")).first())
    buckets = max(1, -(-size // bucket_bytes))
    bucket = F.pmod("t", F.lit(buckets)).cast("int").alias("bucket")

    all_anchors = map_batches(texts.select("t", "text"), find_anchors, "h long, t long, pos int, sure boolean, spread long")
    at = F.struct("t", "pos")
    by_hash = Window.partitionBy("h", "spread")
    repeated = all_anchors.select("t", "pos", "sure", F.min(at).over(by_hash).alias("least"), F.max(at).over(by_hash).alias("most")).where("sure OR least <> most").groupBy("t").agg(F.collect_set("pos").alias("pos"))
    copied = named.groupBy("t", "t2").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    nothing = lambda kind, name: F.lit(None).cast(kind).alias(name)
    about = repeated.select(bucket, "t", nothing("long", "t2"), "pos", nothing("long", "doc_id"), nothing("long", "n")).unionByName(copied.select(bucket, "t", "t2", nothing("array<int>", "pos"), "doc_id", "n"))

    def runs(left: pa.Table, right: pa.Table) -> pa.Table:
        nothing = pa.table({"bucket": pa.array([], pa.int32()), "run": pa.array([], pa.binary()), "home": pa.array([], pa.binary())})
        if not left.num_rows:
            return nothing
        mine = int(left["bucket"][0].as_py())
        t, t2 = left["t"].to_numpy(), left["t2"].to_numpy()
        o = np.lexsort((t2, t))
        one = o[np.r_[True, (np.diff(t[o]) != 0) | (np.diff(t2[o]) != 0)]]
        wanted: dict[int, np.ndarray] = {}
        groups: dict[tuple[int, int], tuple[int, int]] = {}
        for a, b, p, d, n in zip(*(right[c].to_pylist() for c in ("t", "t2", "pos", "doc_id", "n")), strict=True):
            if n is None:
                wanted[a] = np.asarray(p)
            else:
                groups[a, b] = d, n
        keys = list(zip(t[one].tolist(), t2[one].tolist(), strict=True))
        use = [k for k, key in enumerate(keys) if key in groups or key[0] in wanted]
        if not use:
            return nothing
        text = left["text"].combine_chunks().take(pa.array(one[use]))
        ids = left["doc_id"].to_numpy()
        copies = np.array([groups.get(keys[k], (0, 1))[1] for k in use], np.int64)
        doc = np.array([groups[keys[k]][0] if keys[k] in groups else ids[one[k]] for k in use], np.int64)
        length = np.zeros(len(use), np.int64)
        sym, owner, pos = [np.zeros((0, DEPTH), np.uint32)], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        for k, r, o in K.chunks(*K.buffers(text)):
            w = K.Words(r, o)
            size = np.diff(w.first)
            length[k : k + len(size)] = size
            mark = np.zeros(len(w.hash) + 2, np.int32)
            for i in np.flatnonzero(size >= MIN_WORDS):
                p = wanted.get(keys[use[k + i]][0])
                if p is not None:
                    np.add.at(mark, w.first[i] + np.clip(p - _SPREAD, 0, size[i] - MIN_WORDS + 1), 1)
                    np.add.at(mark, w.first[i] + np.minimum(p + 1, size[i] - MIN_WORDS + 1), -1)
            at = np.flatnonzero(np.cumsum(mark)[: len(w.hash)] > 0)
            if len(at):
                blocks = (K.grams(w, BLOCK)[0] >> np.uint64(32)).astype(np.uint32)
                sym.append(np.stack([blocks[at + BLOCK * d] for d in range(DEPTH)], 1))
                owner.append((w.row[at] + k).astype(np.int32))
                pos.append((at - w.first[w.row[at]]).astype(np.int32))
        owner, pos = np.concatenate(owner), np.concatenate(pos)
        key, lcp, count, o = run_of(np.concatenate(sym), doc[owner], pos)
        owner, pos = owner[o], pos[o]
        first = np.cumsum(count) - count
        out: list[tuple[int, bytes | None, bytes | None]] = [(buckets + mine, None, pack(count, owner, pos, doc, length, t[one[use]], t2[one[use]], copies))]
        # block hashes are uniform, so equal ranges of the first symbol are even parts of the order
        target = (key[:, 0].astype(np.uint64) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        edge = np.searchsorted(target, np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(edge)):
            a, b = edge[k], edge[k + 1]
            part = lcp[a:b].copy()
            part[0] = 0
            out.append((int(k), pack(part, front_code(key[a:b], part), count[a:b] > 1, doc[owner[first[a:b]]], pos[first[a:b]], np.array([mine, a])), None))
        return pa.table([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.binary())], ["bucket", "run", "home"])

    shape = "bucket int, run binary, home binary"
    once = texts.select(bucket, "doc_id", "t", "t2", "text").mapInArrow(_once, "bucket int, doc_id long, t long, t2 long, text string")
    sorted_runs = once.groupBy("bucket").cogroup(about.groupBy("bucket")).applyInArrow(runs, shape)

    def merge_runs(rows: pa.Table) -> pa.Table:
        if int(rows["bucket"][0].as_py()) >= buckets:
            return rows
        sent = [(buckets + b, verdict) for b, verdict in merge_range(rows["run"].to_pylist())]
        return pa.table([pa.array([b for b, _ in sent], pa.int32()), pa.array([v for _, v in sent], pa.binary()), pa.array([None] * len(sent), pa.binary())], ["bucket", "run", "home"])

    names = ["doc_id", "start_word", "end_word", "first_doc_id", "t", "t2", "copies"]

    def spans_of(rows: pa.Table) -> pa.Table:
        home = next(x for x in rows["home"].to_pylist() if x is not None)
        columns = bucket_spans(home, [x for x in rows["run"].to_pylist() if x is not None], removable)
        return pa.table([pa.array(c) for c in columns], names)

    merged = sorted_runs.groupBy("bucket").applyInArrow(merge_runs, shape)
    spans = written(merged.groupBy("bucket").applyInArrow(spans_of, ", ".join(f"{n} long" for n in names)), "spans")
    places = [F.col("start_word").cast("int"), F.col("end_word").cast("int"), F.col("first_doc_id")]
    # copies are named where they lie: a text that a third of all rows hold gathers nowhere
    whole = spans.where("copies > 1").withColumnRenamed("doc_id", "least")
    copies = with_keys(named.select("doc_id", "t", "t2"), whole, ["t", "t2"], "copies", total)
    if removable:
        copies = copies.where("doc_id <> least")  # the first keeps what isn't removed for its own windows
    return spans.where("copies = 0").select("doc_id", *places).unionByName(copies.select("doc_id", *places)).where(F.col("doc_id") != LAST)


def without_repeats(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows and columns; of every passage of 50 words or more that repeats, in one text or several, only the first copy stays.

    Rows count in the order of doc_id (nulls last), then of the text's hash; equal
    rows are copies. A removed span goes from its first word to the word after it, or
    to the text's end, so a later copy of a whole text becomes the empty text (what
    precedes its first word stays). Null and empty texts stay as they are.
    """
    row, gone = fresh(docs, "__row"), fresh(docs, "__gone")
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).groupBy("doc_id").count()
    if ids.where(f"count > 1 OR doc_id IS NULL OR doc_id = {LAST}").isEmpty():
        kept = docs.withColumn(row, F.col("doc_id").cast("long"))
    else:  # numbers in this order, over files, so that they are the same whenever they are read
        kept = written(docs.orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("text")).withColumn(row, F.monotonically_increasing_id()), "numbered")
    spans = repeated_passages(kept.select(F.col(f"`{row}`").alias("doc_id"), "text"), bucket_bytes, removable=True)
    spans = spans.groupBy(F.col("doc_id").alias(row)).agg(F.sort_array(F.collect_list(F.struct("start_word", "end_word"))).alias(gone))
    names = docs.columns
    at = names.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, spans = b.column(at).to_pylist(), b.column(len(names)).to_pylist()
            for k in [k for k, x in enumerate(spans) if x]:
                data = text[k].encode()
                raw = np.frombuffer(data, np.uint8)
                start = K.Words(raw, np.array([0, len(raw)])).start.tolist() + [len(raw)]
                parts, done = [], 0
                for x in spans[k]:
                    parts.append(data[done : start[x["start_word"]]])
                    done = start[x["end_word"]]
                text[k] = b"".join([*parts, data[done:]]).decode()
            columns = b.columns[: len(names)]
            columns[at] = pa.array(text, columns[at].type)
            yield pa.record_batch(columns, names=names)

    joined = kept.join(spans, row, "left").select(*(f"`{c}`" for c in names), f"`{gone}`")
    return joined.mapInArrow(cut, docs.schema)


def op4_suffix_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


SQL = {
    "op4_suffix_dedup": """
WITH w AS (
  SELECT doc_id, generate_subscripts(w, 1) - 1 AS p, unnest(w) AS h FROM (
    SELECT doc_id, list_transform(regexp_extract_all(text, '[0-9A-Za-z\\x{80}-\\x{10ffff}]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents)
), g AS (
  SELECT doc_id, p, md5(string_agg(h, ' ') OVER f) AS g, count(*) OVER f AS n FROM w
  WINDOW f AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)
), r AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY g) AS c, min(doc_id) OVER (PARTITION BY g) AS first FROM g WHERE n = 50
), m AS (
  SELECT doc_id, p, first, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) < 50 THEN 0 ELSE 1 END AS opens FROM r WHERE c > 1
), s AS (
  SELECT doc_id, p, first, sum(opens) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM m
)
SELECT doc_id, min(p)::INTEGER AS start_word, (max(p) + 50)::INTEGER AS end_word, min(first) AS first_doc_id FROM s GROUP BY doc_id, span
"""
}
