"""Token counts by heap-and-linked-list byte-pair merging.

A piece of text starts as its bytes in a linked list; the adjacent pair of the
lowest rank (leftmost on ties) is popped from a heap and merged until no pair
has a rank. The count is symbols minus merges; no identifiers are made.
"""

from __future__ import annotations

import re
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import id_text, map_batches, table
from .token_orc import PATTERN, VOCABULARY, read_ranks

#: Counts of so many distinct pieces are remembered by a worker before it starts afresh.
REMEMBERED = 400_000
_counters: dict = {}
# Over characters that both engines class alike, the standard one splits as PATTERN does, faster.
_ALIKE = re.compile("[^\t\n\r -~¡-©«-±´-¸»¿-ſ‐-‧€]")
_FAST = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


class Counter(dict):
    """Piece -> its number of tokens, worked out when first asked for."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values(), default=0) + 1
        self.byte = [ranks.get(bytes([b]), -1) for b in range(256)]
        if min(self.byte) < 0:
            raise ValueError("the vocabulary lacks single bytes")
        #: left * size + right -> rank of the merged symbol, for every split of every token
        self.pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    self.pairs[a * self.size + b] = rank

    def __missing__(self, piece: str) -> int:
        n = self[piece] = self.count(piece.encode("utf-8", "surrogatepass"))
        return n

    def count(self, data: bytes) -> int:
        n = len(data)
        if n < 2:
            return n
        size, rank_of = self.size, self.pairs.get
        byte = self.byte
        symbol = [byte[b] for b in data]
        shift = n.bit_length()
        mask = (1 << shift) - 1
        heap = []
        left = symbol[0]
        for i in range(1, n):
            right = symbol[i]
            r = rank_of(left * size + right)
            if r is not None:
                heap.append(r << shift | i - 1)
            left = right
        if not heap:
            return n
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        merges = 0
        while heap:
            x = heappop(heap)
            i = x & mask
            s = symbol[i]
            if s < 0:
                continue
            j = after[i]
            if j >= n:
                continue
            r = x >> shift
            if rank_of(s * size + symbol[j]) != r:
                continue
            symbol[i] = r
            symbol[j] = -1
            k = after[i] = after[j]
            merges += 1
            if k < n:
                before[k] = i
                q = rank_of(r * size + symbol[k])
                if q is not None:
                    heappush(heap, q << shift | i)
            h = before[i]
            if h >= 0:
                q = rank_of(symbol[h] * size + r)
                if q is not None:
                    heappush(heap, q << shift | h)
        return n - merges


def counter(path: str = VOCABULARY) -> tuple[Counter, re.Pattern]:
    """The counter of a vocabulary, once a worker, and the full pattern."""
    if path not in _counters:
        import regex

        _counters[path] = Counter(read_ranks(path)), regex.compile(PATTERN)
    return _counters[path]


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row; an empty text has 0, a null one null; repeated rows are counted one by one."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        known, full = counter(vocabulary)
        n, size = [], []
        for x in b.column("text"):
            text = x.as_py()
            if text is None:
                n.append(None)
                size.append(None)
                continue
            pieces = (full if _ALIKE.search(text) else _FAST).findall(text)
            n.append(sum(map(known.__getitem__, pieces)))
            size.append(len(text.encode("utf-8", "surrogatepass")))
            if len(known) > REMEMBERED:
                known.clear()
        return pa.record_batch([b.column("doc_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return map_batches(id_text(docs), each, "doc_id long, n_bytes long, n_tokens long")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
