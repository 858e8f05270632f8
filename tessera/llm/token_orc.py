"""Token identifiers as ORC: run-length-encoded integers, row indexes, Bloom filters on doc_id."""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text, map_batches, shared_dir, table

#: Vocabulary file of a public byte-level BPE; a path that all executors can read.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
STRIPE_BYTES = 64 << 20
ROW_INDEX_STRIDE = 1000
BLOOM_FPP = 0.01
#: Runs of white space longer than this are split by ``regex``.
LONG_RUN = 20_000
_LONG_RUN = re.compile(rf"\s{{{LONG_RUN}}}")
_encoders: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def encoder(path: str = VOCABULARY):
    """The tokenizer of a vocabulary, once a worker."""
    if path not in _encoders:
        import tiktoken

        _encoders[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    return _encoders[path]


def encode(enc, text: str) -> list[int]:
    """The identifiers of a text; one with a very long run of white space, on which the tokenizer's own pattern overflows its stack, is split into pieces by another engine."""
    if len(text) <= LONG_RUN or not _LONG_RUN.search(text):
        return enc.encode_ordinary(text)
    import regex

    out: list[int] = []
    for piece in regex.findall(PATTERN, text):
        out += enc.encode_ordinary(piece) if len(piece) <= LONG_RUN else enc._encode_single_piece(piece)
    return out


def tokenized(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens, tokens) of every row, partition by partition in its order; a null text has null tokens and null n_tokens, an empty one none and 0."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(vocabulary)
        text = b.column("text")
        parts, size = [], np.zeros(b.num_rows + 1, np.int64)
        for k, x in enumerate(text):
            if x.is_valid:
                ids = np.array(encode(enc, x.as_py()), np.int32)
                parts.append(ids)
                size[k + 1] = len(ids)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        null = np.asarray(text.is_null())
        ends = np.cumsum(size)
        offsets = pa.array(ends.astype(np.int32), mask=np.r_[null, False]) if null.any() else pa.array(ends.astype(np.int32))
        return pa.record_batch([b.column("doc_id"), pa.array(size[1:], pa.int64(), mask=null), pa.ListArray.from_arrays(offsets, pa.array(flat))], ["doc_id", "n_tokens", "tokens"])

    return map_batches(docs, each, "doc_id long, n_tokens long, tokens array<int>")


def write_tokens(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, ranged: bool = False) -> None:
    """ORC files whose readers skip stripes and row groups by the doc_id statistics and Bloom filters, and split at stripes.

    Rows are in doc_id order within a file. ``ranged`` also gives the files ranges of doc_id of
    their own, so that statistics rule out whole files; it moves every text once, and
    without it the Bloom filters rule out what the overlapping ranges don't.
    """
    rows = id_text(docs)
    rows = (rows.repartitionByRange("doc_id") if ranged else rows).sortWithinPartitions("doc_id")
    (
        tokenized(rows, vocabulary)
        .write.option("orc.compress", "NONE")  # run-length-encoded identifiers hardly compress further
        .option("orc.stripe.size", STRIPE_BYTES)
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", ROW_INDEX_STRIDE)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", BLOOM_FPP)
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The token table; filters on doc_id reach the ORC reader."""
    return spark.read.schema("doc_id long, n_tokens long, tokens array<int>").orc(path)


def token_table(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The documents' tokens as read again from ORC files in the shared folder.

    One row for each row, repeated rows, null and empty texts included (see
    ``tokenized``); other columns are not read.
    """
    path = shared_dir(docs.sparkSession, "tokens")
    write_tokens(docs, path, vocabulary)
    return read_tokens(docs.sparkSession, path)


def op3_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(table(spark, sf_dir, "documents"))
