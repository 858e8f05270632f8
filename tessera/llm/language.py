"""Language identification by language-bitmask n-gram filters.

One bit-sliced Bloom filter holds every language: a slot is a bit mask with one
bit a language, a lookup ANDs the slots of an n-gram's hashes and so returns at
once all languages that contain it. A text's hits per language are counted,
corrected for that language's false-positive rate, and decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import kernel as K
from .common import fresh, map_batches, one_text_each, table, trimmed

GRAM = 4
HASHES = 3
SLOTS = 1 << 22
#: The fit reads at most so many labelled rows a language, chosen by hash of the id; half of them judge a document.
SAMPLE_PER_LANGUAGE = 800
#: A text is rejected if no language explains this share of its n-grams.
LEAST_SHARE = 0.5
#: N-grams that are looked up together.
PIECE = 1 << 20


def _folded() -> np.ndarray:
    t = np.full(256, 32, np.uint8)
    for b in range(256):
        if K._IS_WORD[b] and not 48 <= b < 58:
            t[b] = b + 32 if 65 <= b < 91 else b
    return t


#: Letters, ASCII lower-cased; every other byte is a border.
FOLD = _folded()


def byte_grams(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces of (hash, row) of the n-grams of every row, a row taken between two borders; n-grams that begin with two borders are left out."""
    rows = len(offsets) - 1
    # two borders part the rows
    out = np.full(len(raw) + rows * 2, 32, np.uint8)
    begin = offsets + 2 * np.arange(rows + 1)
    fold = FOLD[raw]
    if rows == 1:
        out[1:-1] = fold
    else:
        out[np.arange(len(raw)) + np.repeat(begin[:-1] - offsets[:-1] + 1, np.diff(offsets))] = fold
    for a in range(0, len(out) - GRAM + 1, PIECE):
        m = min(PIECE, len(out) - GRAM + 1 - a)
        low, high = (int(np.searchsorted(begin, x, "right")) - 1 for x in (a, a + m - 1))
        cut = np.clip(begin[low : high + 2] - a, 0, m)
        row = np.repeat(np.arange(low, high + 1), np.diff(cut))
        g = out[a : a + m].astype(np.uint64)
        for k in range(1, GRAM):
            g = (g << np.uint64(8)) | out[a + k : a + k + m]
        end = np.minimum(begin[low + 1 : high + 2] - GRAM + 1 - a, m)
        inside = (np.arange(m) < np.repeat(end, np.diff(cut))) & ((out[a : a + m] != 32) | (out[a + 1 : a + m + 1] != 32))
        yield K.mix(g[inside]), row[inside]


class Filter:
    """The bit-sliced filter: ``mask[slot, w]`` has bit b of word w if set 64 * w + b of n-grams set the slot.

    Each language has two sets, of the sampled texts of either half of all documents
    (by a hash of the id). A document is judged by the other half's set, so a sampled text is never
    judged by its own n-grams and every document is judged alike, whatever the sample.
    """

    def __init__(self, languages: list[str], slots: int = SLOTS, hashes: int = HASHES):
        self.languages, self.hashes, self.slots = languages, hashes, slots
        self.sets = 2 * len(languages)
        self.kind = next((t for t in (np.uint8, np.uint16, np.uint32) if self.sets <= np.iinfo(t).bits), np.uint64)
        self.mask = np.zeros((slots, max(1, -(-self.sets // 64))), self.kind)

    def _slots(self, g: np.ndarray):
        step = (g >> np.uint64(33)) | np.uint64(1)
        for k in range(self.hashes):
            yield ((g + np.uint64(k) * step) & np.uint64(self.slots - 1)).astype(np.int64)

    def add(self, number: int, g: np.ndarray) -> None:
        """N-grams of a set: 2 * language + half."""
        for s in self._slots(np.unique(g)):
            self.mask[s, number // 64] |= self.kind(1 << number % 64)

    def bit(self, masks: np.ndarray, number: int) -> np.ndarray:
        return (masks[:, number // 64] >> self.kind(number % 64)) & self.kind(1)

    def rates(self) -> np.ndarray:
        """False-positive rate of each set: its share of set slots to the number of hashes."""
        return np.array([np.mean(self.bit(self.mask, k)) ** self.hashes for k in range(self.sets)])

    def containing(self, g: np.ndarray) -> np.ndarray:
        """Masks of the sets that contain each n-gram."""
        out = None
        for s in self._slots(g):
            out = self.mask[s] if out is None else out & self.mask[s]
        return out

    def shares(self, raw: np.ndarray, offsets: np.ndarray, rates: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows x languages share of n-grams, corrected, by the set of the half that the row isn't in; n-grams of each row)."""
        rows = len(offsets) - 1
        n = np.zeros(rows, np.int64)
        hits = np.zeros((rows, self.sets))
        for g, row in byte_grams(raw, offsets):
            if not len(g):
                continue
            # rows of the piece
            first = int(row[0])
            row = row - first
            count = int(row[-1]) + 1
            n[first : first + count] += np.bincount(row, minlength=count)
            m = self.containing(g)
            if self.sets <= 8:  # popcounts over the distinct masks of each row
                counts = np.bincount(row * 256 + m[:, 0], minlength=count * 256).reshape(count, 256)
                hits[first : first + count] += counts @ ((np.arange(256)[:, None] >> np.arange(self.sets)) & 1)
            else:
                for k in range(self.sets):
                    hits[first : first + count, k] += np.bincount(row, self.bit(m, k).astype(float), count)
        share = np.clip((hits - n[:, None] * rates) / ((1 - rates) * np.maximum(n, 1)[:, None]), 0, 1)
        return np.where(half[:, None] == 0, share[:, 1::2], share[:, 0::2]), n


def half_of(column: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("half"), column.cast("long")), F.lit(2)).cast("int")


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, slots: int = SLOTS, hashes: int = HASHES) -> Filter:
    """A filter from at most ``per_language`` rows of each value of ``lang``, each with its own id; rows with a null in doc_id, text or lang are not used.

    The filter has 2 bits a slot for a language, so any number of languages fits.
    """
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang")).where("doc_id IS NOT NULL AND lang IS NOT NULL").distinct()
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    # ids only: the windows never hold a text, and a language keeps per_language rows at most
    chosen = {(r.doc_id, r.lang): r.half for r in known.select("doc_id", "lang", nth.alias("nth"), half_of(F.col("doc_id")).alias("half")).where(F.col("nth") <= per_language).collect()}
    filters = Filter(sorted({x for _, x in chosen}), slots, hashes)
    if not chosen:
        return filters
    rows = one_text_each(docs, sorted({x for x, _ in chosen}), ("lang",))
    number = {x: k for k, x in enumerate(filters.languages)}
    # an id may have rows of other languages too, which are not of the sample
    keys = [(i, x) for i, x in zip(rows["doc_id"].to_pylist(), rows["lang"].to_pylist(), strict=True)]
    of = np.array([2 * number[x] + chosen[i, x] if (i, x) in chosen else -1 for i, x in keys], np.int64)
    for k in np.unique(of[of >= 0]):
        text = rows["text"].filter(pa.array(of == k)).combine_chunks()
        for g, _ in byte_grams(*K.buffers(text)):
            filters.add(int(k), g)
    return filters


def identify(docs: DataFrame, filters: Filter, least_share: float = LEAST_SHARE) -> DataFrame:
    """(doc_id, language, share, grams, accepted) of every row.

    ``share`` is the corrected share of the best language; ties go to the first by
    name. Accepted are texts with a share of ``least_share`` at least. A text
    without letters, an empty or null one has no language and share 0 and is
    rejected; repeated rows are judged one by one. Where the filter has no language,
    as when no row is labelled, no text has one and all are rejected.
    """
    sent = docs.sparkSession.sparkContext.broadcast((filters, filters.rates()))

    def judge(b: pa.RecordBatch) -> pa.RecordBatch:
        f, rates = sent.value
        names = np.array([*f.languages, None], object)
        raw, offsets = K.buffers(b.column("text"))
        half = b.column("half").to_numpy()
        best, share, grams = [], [], []
        for k, r, o in K.chunks(raw, offsets):
            if f.languages:
                s, n = f.shares(r, o, rates, half[k : k + len(o) - 1])
            else:
                s, n = np.zeros((len(o) - 1, 1)), np.zeros(len(o) - 1, np.int64)
            top = s.argmax(1)
            value = s[np.arange(len(top)), top]
            best.append(np.where(value > 0, top, len(f.languages)))
            share.append(value)
            grams.append(n)
        share = np.round(np.concatenate(share), 6)
        best = np.concatenate(best)
        return pa.record_batch([b.column("doc_id"), pa.array(names[best], pa.string()), pa.array(share), pa.array(np.concatenate(grams), pa.int64()), pa.array((share >= least_share) & (best < len(f.languages)))], ["doc_id", "language", "share", "grams", "accepted"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), half_of(F.col("doc_id")).alias("half"))
    return map_batches(narrow, judge, "doc_id long, language string, share double, grams long, accepted boolean")


def accepted(docs: DataFrame, filters: Filter, least_share: float = LEAST_SHARE) -> DataFrame:
    """The rows that ``identify`` accepts (none if no row is labelled: then no language is known); all columns, no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast((filters, filters.rates()))
    # the text's place is taken by position, so clashing column names do no harm
    at = docs.columns.index("text")

    def sift(batches):
        f, rates = sent.value
        for b in batches:
            if not b.num_rows or not f.languages:
                continue
            raw, offsets = K.buffers(b.column(at))
            half = b.columns[-1].to_numpy()
            keep = np.concatenate([f.shares(r, o, rates, half[k : k + len(o) - 1])[0].max(1) for k, r, o in K.chunks(raw, offsets)])
            yield pa.record_batch(b.columns[:-1], names=b.schema.names[:-1]).filter(pa.array(np.round(keep, 6) >= least_share))

    return docs.withColumn(fresh(docs, "__half"), half_of(F.col("doc_id"))).mapInArrow(trimmed(sift), docs.schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, fit(docs))
