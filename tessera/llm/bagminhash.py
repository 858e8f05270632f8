"""Near-duplicate removal with BagMinHash signatures.

A text is the multiset of its two-word shingles (its single word, if it has but
one); words are by script as in ``kernel``. Weights are discretised to whole counts and split into dyadic levels
(0,1], (1,2], (2,4], (4,8]...; every (shingle, level) is a Poisson process whose
rate is the level's width and whose points carry a time, a register and a place
within the level. A point counts only if its place is within the weight, which
thins a level's process to the part below the weight, and a process ends as
soon as its next point is later than every register. The smallest time a
register sees makes P(equal registers) the weighted Jaccard similarity.

Bands of registers give candidates; multisets then decide. Texts with equal
multisets are one node; in a bucket all nodes are compared with its smallest,
and those that fail with all others of the bucket, so no bucket is capped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from .common import fresh, id_text, map_batches, table, with_keys, written

SHINGLE = 2
#: A pair at the threshold meets in a band with a probability of 0.91, one of 0.7 in similarity with 0.996.
BANDS = 30
ROWS = 5
#: Reached by copies with every eighth word replaced, or with two thirds more text.
THRESHOLD = 0.6
_G = np.uint64(0x9E3779B97F4A7C15)


def bags(words: K.Words, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, count), ordered by row and shingle; a row of fewer words than n has them as its one shingle."""
    g, valid = K.grams(words, n)
    row = words.row[: len(g)][valid]
    g = g[valid]
    size = np.diff(words.first)
    short = np.flatnonzero((size > 0) & (size < n))
    if len(short):
        whole = np.zeros(len(short), K.U)
        for k in range(n - 1):
            has = size[short] > k
            whole[has] = K.mix(whole[has] + words.hash[words.first[short[has]] + k] + K.U(k + 1))
        g, row = np.r_[g, whole], np.r_[row, short.astype(row.dtype)]
    o = np.lexsort((g, row))
    g, row = g[o], row[o]
    new = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (row[1:] != row[:-1])]) if len(g) else np.zeros(0, np.int64)
    return row[new].astype(np.int64), g[new], np.diff(np.r_[new, len(g)])


def signatures(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, rows: int, m: int) -> np.ndarray:
    """rows x m register times; a row without shingles keeps infinity."""
    sig = np.full(rows * m, np.inf)
    seeds, at, low, top = [], [], [], []
    level = 0
    lo, hi = 0, 1
    act = np.arange(len(row))
    while len(act):
        seeds.append(K.mix(shingle[act] + np.uint64((level + 1) * int(_G) % 2**64)))
        at.append(row[act])
        low.append(np.full(len(act), lo))
        top.append(weight[act])
        level, lo, hi = level + 1, hi, 2 * hi
        act = act[weight[act] > lo]
    if not seeds:
        return sig.reshape(rows, m)
    seed, at, low, top = (np.concatenate(x) for x in (seeds, at, low, top))
    width = np.maximum(low, 1)
    few = np.bincount(at, minlength=rows)[at] < m
    for part, block in ((np.flatnonzero(~few), 1), (np.flatnonzero(few), 32)):
        s, r, lo, w, t = seed[part], at[part], low[part], width[part], top[part]
        time = np.zeros(len(part))
        k = 0
        while len(s):
            u = K.mix(s[:, None] + (np.arange(k + 1, k + block + 1, dtype=np.uint64) * _G)[None, :])
            k += block
            when = time[:, None] + np.cumsum(-np.log1p(-((u >> np.uint64(11)).astype(np.float64) * 2.0**-53)), axis=1) / w[:, None]
            v = K.mix(u ^ np.uint64(0x5851F42D4C957F2D))
            register = ((v >> np.uint64(40)) * np.uint64(m) >> np.uint64(24)).astype(np.int64)
            place = lo[:, None] + 1 + ((v & np.uint64(0xFFFFFF)).astype(np.int64) * w[:, None] >> 24)
            ok = place <= t[:, None]
            np.minimum.at(sig, (r[:, None] * m + register)[ok], when[ok])
            time = when[:, -1]
            live = time < sig.reshape(rows, m).max(1)[r]
            s, r, lo, w, t, time = s[live], r[live], lo[live], w[live], t[live], time[live]
    return sig.reshape(rows, m)


def _hash_runs(values: np.ndarray, starts: np.ndarray, salt: int) -> np.ndarray:
    """An order-sensitive hash of each run of values."""
    place = np.arange(len(values)) - np.repeat(starts, np.diff(np.r_[starts, len(values)]))
    return K.mix(np.add.reduceat(K.mix(values + K.mix(place.astype(np.uint64) + np.uint64(salt))), starts))


def sketch(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, t, n, bag1, bag2, bands): a hash of the text, the number of shingles, 128 bits that name the multiset, and a hash of each band; a text without words has no row."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch | None:
        ids, size, one, two, keys = [], [], [], [], []
        raw, offsets = K.buffers(b.column("text"))
        for k, r, o in K.chunks(raw, offsets):
            row, g, c = bags(K.Words(r, o, scripts=True))
            if not len(row):
                continue
            n = len(o) - 1
            sig = signatures(row, g, c, n, bands * rows)
            starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            has = row[starts]
            item = K.mix(g ^ K.mix(c.astype(np.uint64)))
            ids.append(has + k)
            size.append(np.add.reduceat(c, starts))
            one.append(_hash_runs(item, starts, 1))
            two.append(_hash_runs(item, starts, 2))
            bits = sig[has].reshape(len(has) * bands, rows).view(np.uint64)
            band = K.mix(np.tile(np.arange(bands, dtype=np.uint64), len(has)) + np.uint64(77))
            for q in range(rows):
                band = K.mix(band * np.uint64(0xD6E8FEB86659FD93) + bits[:, q])
            keys.append(band)
        if not ids:
            return None
        ids = np.concatenate(ids)
        i64 = lambda x: pa.array(np.concatenate(x).view(np.int64))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(ids) * bands + 1, bands, dtype=np.int32)), i64(keys))
        at = pa.array(ids)
        return pa.record_batch([b.column("doc_id").take(at), b.column("t").take(at), pa.array(np.concatenate(size).astype(np.int64)), i64(one), i64(two), lists], ["doc_id", "t", "n", "bag1", "bag2", "bands"])

    return map_batches(docs, each, "doc_id long, t long, n long, bag1 long, bag2 long, bands array<long>")


def multisets(docs: DataFrame) -> DataFrame:
    """(doc_id, bag): the shingles of each text as sorted 32-bit hashes, one for each occurrence."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        raw, offsets = K.buffers(b.column("text"))
        for _, r, o in K.chunks(raw, offsets):
            row, g, c = bags(K.Words(r, o, scripts=True))
            row, g = np.repeat(row, c), (np.repeat(g, c) >> np.uint64(32)).astype(np.uint32)
            cut = np.searchsorted(row, np.arange(len(o)))
            out += [np.sort(g[x:y]).tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)]
        return pa.record_batch([b.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "bag"])

    return map_batches(docs, each, "doc_id long, bag binary")


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted multisets."""
    va, ca = np.unique(a, return_counts=True)
    vb, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    both = np.minimum(ca[i], cb[j]).sum()
    return float(both / max(len(a) + len(b) - both, 1))


def _verified(edges: DataFrame, bag: DataFrame) -> DataFrame:
    """Edges (a, b) with their similarity."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (b.column(c).to_pylist() for c in ("x", "y"))
        sim = [overlap(np.frombuffer(p, np.uint32), np.frombuffer(q, np.uint32)) for p, q in zip(x, y, strict=True)]
        return pa.record_batch([b.column("a"), b.column("b"), pa.array(sim, pa.float64())], ["a", "b", "similarity"])

    pairs = edges.join(bag.select(F.col("doc_id").alias("a"), F.col("bag").alias("x")), "a").join(bag.select(F.col("doc_id").alias("b"), F.col("bag").alias("y")), "b").select("a", "b", "x", "y")
    return map_batches(pairs, each, "a long, b long, similarity double")


def _with_least(edges: DataFrame, total: int) -> DataFrame:
    """(u, v, m): m is the smallest v of u; however many edges a node has, they stay where they are."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    return with_keys(edges.select("u", "v"), least, ["u"], "n", total).select("u", "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component, by alternating large and small stars; every round is a written table."""
    edges = written(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    state = edges.agg(F.count(F.lit(1)), F.lit(0)).first()
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, 2 * state[0]).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v").distinct()
        large = written(large, "edges")
        small = _with_least(large, large.count())
        small = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        edges = written(small, "edges")
        # sums over hashes tell whether a round changed the edges
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def _grouped(docs: DataFrame, threshold: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """((doc_id, t, n, bag1, bag2, bands) of the rows that stand for their documents, (node, root) of all documents that aren't their group's smallest)."""
    known = id_text(docs).where("doc_id IS NOT NULL AND text IS NOT NULL").withColumn("t", F.xxhash64("text"))
    flat = written(sketch(known, bands, rows), "sketch")
    several = flat.groupBy("doc_id").agg(F.min(F.struct("bag1", "bag2")).alias("bag"), F.max(F.struct("bag1", "bag2")).alias("other")).where("bag <> other").drop("other")
    if not several.isEmpty():  # of an id's texts the one with the smallest multiset's hash stands, whichever row came first
        stands = (F.col("bag").isNull()) | ((F.col("bag.bag1") == F.col("bag1")) & (F.col("bag.bag2") == F.col("bag2")))
        flat = written(flat.join(several.hint("merge"), "doc_id", "left").where(stands).drop("bag"), "sketch")
    total = flat.count()
    bag_of = flat.groupBy("bag1", "bag2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    same = with_keys(flat.select("doc_id", "bag1", "bag2"), bag_of.where("copies > 1"), ["bag1", "bag2"], "copies", total).where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    reps = flat.groupBy("bag1", "bag2").agg(F.min_by(F.struct("bands", "t", "n"), "doc_id").alias("x"), F.min("doc_id").alias("node")).select("node", "x.*")
    reps = written(reps, "nodes")
    bucket = reps.select("node", "n", F.explode("bands").alias("key"))
    hubs = bucket.groupBy("key").agg(F.min(F.struct("node", "n")).alias("hub"), F.count(F.lit(1)).alias("size")).where("size > 1").select("key", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n"), "size")
    member = written(with_keys(bucket, hubs, ["key"], "size", total * bands), "buckets")
    # the sizes alone rule out a pair: the overlap is at most the smaller one, the union at least the larger
    may = lambda x, y: F.least(x, y) >= F.lit(threshold - 1e-9) * F.greatest(x, y)
    star = member.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"), may("hub_n", "n").alias("may")).distinct()
    near = star.where("may").select("a", "b")
    wanted = near.select(F.col("a").alias("node")).unionByName(near.select(F.col("b").alias("node"))).distinct()
    wanted = written(wanted.join(reps.select("node", "t").hint("merge"), "node"), "wanted")
    bag = written(_bags_of(known, wanted), "bags")
    first = written(_verified(near, bag), "verified")
    # nodes that aren't like their bucket's hub are compared with all its other nodes of a size that may fit
    failed = first.where(F.col("similarity") < threshold).select(F.col("a").alias("hub"), F.col("b").alias("left")).unionByName(star.where("NOT may").select(F.col("a").alias("hub"), F.col("b").alias("left")))
    again = member.select("key", "hub", F.col("node").alias("left"), F.col("n").alias("left_n")).join(failed, ["hub", "left"])
    others = member.select("key", F.col("node").alias("right"), "n").where("right <> hub")
    more = again.join(others, "key").where((F.col("left") != F.col("right")) & may("left_n", "n")).select(F.least("left", "right").alias("a"), F.greatest("left", "right").alias("b")).distinct()
    more = written(more.join(near, ["a", "b"], "left_anti"), "more")
    late = more.select(F.col("a").alias("node")).unionByName(more.select(F.col("b").alias("node"))).distinct().join(wanted.select("node").hint("merge"), "node", "left_anti")
    if not late.isEmpty():  # nodes whose size didn't fit their hub's
        bag = bag.unionByName(written(_bags_of(known, late.join(reps.select("node", "t").hint("merge"), "node")), "bags"))
    edges = first.unionByName(_verified(more, bag)).where(F.col("similarity") >= threshold).select("a", "b").unionByName(same)
    return flat, components(edges)


def _bags_of(known: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, bag) of the texts (node, t)."""
    w = wanted.select(F.col("node").alias("w_id"), F.col("t").alias("w_t"))
    return multisets(known.join(w.hint("merge"), (known["doc_id"] == w["w_id"]) & (known["t"] == w["w_t"]), "left_semi").select("doc_id", "text")).dropDuplicates(["doc_id"])


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, group_id) of every document that has a near copy; group_id is the group's smallest doc_id.

    Groups are the connected components of pairs whose shingle multisets have a
    weighted Jaccard similarity of ``threshold`` at least. Documents whose
    multisets are equal always are one group. Texts without words (null, empty)
    belong to no group, nor do rows with a null doc_id; rows of one doc_id are
    one document, for which the text with the smallest hash of its multiset stands.
    """
    _, found = _grouped(docs, threshold, bands, rows)
    return found.select(F.col("node").alias("doc_id"), F.col("root").alias("group_id")).unionByName(found.select(F.col("root").alias("doc_id"), F.col("root").alias("group_id")).distinct())


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The documents, of each group only the one with the smallest doc_id; all columns.

    Of repeated rows of one doc_id all stay or go. Rows of a doc_id whose text isn't
    the one that stands for it, and rows without an id, were not compared and stay.
    """
    flat, found = _grouped(docs, threshold, bands, rows)
    mark, text = fresh(docs, "__gone"), fresh(docs, "__gone_text")
    gone = flat.select(F.col("doc_id").alias(mark), F.col("t").alias(text)).join(found.select(F.col("node").alias(mark)).hint("merge"), mark, "left_semi")
    return docs.join(gone.hint("merge"), (docs["doc_id"] == gone[mark]) & (F.xxhash64(docs["text"]) == gone[text]), "left_anti")


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
