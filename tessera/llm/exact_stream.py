"""Exact deduplication by a stateful stream.

1. A file stream reads each new file once and appends a locator of each row, its
   digest, identifier, file and row number, to a table in the shared folder.
2. A second stream takes the locators into keyed state on disk (RocksDB with a
   changelog, no watermark and so no expiry): for each digest the smallest
   (identifier, file, row) and how often it came. A digest met twice is a hit.
3. The rows of hits, and no others, are fetched by their locators: a task reads only
   the row groups that hold some. Full bytes are compared with those of the row
   that the state names, so a digest collision never removes a document.

With a state folder of its own the state outlives the run: a later call reads new
files alone and judges them against all that came before.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LAST, exists, file_system, shared_dir, with_keys, written

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Native memory of the state is bounded for the executor, not for each of its partitions.
_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    "spark.sql.streaming.stateStore.rocksdb.maxWriteBufferNumber": "2",
}
#: Rows of one state partition, about 100 bytes each; the number of partitions is fixed when a state begins.
STATE_ROWS = 1_000_000
#: Rows of a group are compared in parts of so many, each with its own copy of the text that stays.
PART_ROWS = 256
#: Fetched rows are grouped by file and this many rows of it; a task fetches about so many.
BLOCK_ROWS = 1 << 17
FETCH_ROWS = 20_000
_LOCATOR = "digest binary, id long, file string, row long"


def _stream(spark: SparkSession, df: DataFrame, log: str, start) -> None:
    start(df.writeStream.option("checkpointLocation", log).trigger(availableNow=True)).start().awaitTermination()


def fetch(rows: DataFrame, n: int) -> DataFrame:
    """``rows``, about ``n``, with (file, row) and their ``text``, read from the files' row groups that hold some of them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        name = reader = None
        edges = np.zeros(1, np.int64)
        group, pieces, at = -1, None, 0  # the row group being read, its batches, the first row of the last batch
        piece = None

        def text_of(rows: np.ndarray) -> pa.Array:
            """Texts of ascending row numbers of the open file."""
            nonlocal group, pieces, at, piece
            out, k = [], 0
            while k < len(rows):
                g = int(np.searchsorted(edges, rows[k], "right")) - 1
                if g != group or rows[k] < at:
                    group, at, piece = g, int(edges[g]), None
                    pieces = reader.iter_batches(2048, row_groups=[g], columns=["text"])
                while piece is None or rows[k] >= at + len(piece):
                    at += 0 if piece is None else len(piece)
                    piece = next(pieces).column(0).cast(pa.large_string())
                end = k + int(np.searchsorted(rows[k:], min(at + len(piece), edges[g + 1])))
                out.append(piece.take(pa.array(rows[k:end] - at)))
                k = end
            return pa.concat_arrays(out)

        for b in batches:
            if not b.num_rows:
                continue
            files, row = b.column("file"), b.column("row").to_numpy()
            codes = files.dictionary_encode()
            code = codes.indices.to_numpy()
            cut = np.flatnonzero(np.r_[True, code[1:] != code[:-1], True])
            # a few hundred rows at a time, so that long texts don't pile up
            for a, z in zip(cut[:-1], cut[1:], strict=True):
                uri = codes.dictionary[int(code[a])].as_py()
                if uri != name:
                    system, path = fs.FileSystem.from_uri(uri)
                    reader, name, group = pq.ParquetFile(system.open_input_file(path)), uri, -1
                    edges = np.r_[0, np.cumsum([reader.metadata.row_group(g).num_rows for g in range(reader.num_row_groups)])]
                for k in range(a, z, PART_ROWS):
                    end = min(k + PART_ROWS, z)
                    yield pa.record_batch([*b.slice(k, end - k).columns, text_of(row[k:end]).cast(pa.string())], [*b.schema.names, "text"])

    kind = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // FETCH_ROWS))
    near = rows.repartition(tasks, "file", F.floor(F.col("row") / BLOCK_ROWS)).sortWithinPartitions("file", "row")
    return near.mapInArrow(read, f"{kind}, text string")


def exact_dedup_path(spark: SparkSession, path: str, files_per_batch: int = 64, digest=lambda text: F.sha2(text, 256), state: str | None = None) -> DataFrame:
    """(doc_id, duplicate_of, digest) of every copy of an earlier document below a Parquet path.

    One row of each content stays: that of the smallest doc_id, then file, then
    row; a null doc_id comes last. Every other row is returned once, repeated
    rows of one doc_id too (duplicate_of is then the same doc_id). A null text is
    nobody's copy; empty texts are copies of one another. Other columns are not
    read. An empty table gives no rows. ``digest`` is a parameter so that tests
    can force collisions.

    ``state`` is a folder (shared) that keeps the state for later calls with the same
    path: these read new files alone and return all copies, old and new ones, of
    the contents that came up again. Files may be added, not changed or removed.
    """
    n_rows = spark.read.parquet(path).count()
    schema = spark.read.parquet(path).schema
    root = state or shared_dir(spark, "exact")
    locators, hits_at = f"{root}/locators", f"{root}/hits"
    before = -1
    if exists(spark, hits_at):
        fs, at = file_system(spark, hits_at)
        before = max((int(f.getPath().getName().partition("=")[2]) for f in fs.listStatus(at) if f.isDirectory()), default=-1)
    # as a glob, the source also takes a single file
    glob = path if any(c in path for c in "*?[{") else f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"
    text = F.col("text").cast("string")
    scan = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(glob).where("text IS NOT NULL")
    scan = scan.select(F.unhex(digest(text)).alias("digest"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    conf = _CONF | {"spark.sql.shuffle.partitions": str(max(spark.sparkContext.defaultParallelism, -(-n_rows // STATE_ROWS)))}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        _stream(spark, scan, f"{root}/scan", lambda w: w.format("parquet").option("path", locators))

        def keep(batch: DataFrame, number: int) -> None:
            batch.where("n > 1").select("digest", "first", "n").write.mode("overwrite").parquet(f"{hits_at}/batch={number}")

        if n_rows:
            seen = spark.readStream.schema(_LOCATOR).option("maxFilesPerTrigger", 16 * files_per_batch).parquet(locators)
            counted = seen.groupBy("digest").agg(F.min(F.struct("id", "file", "row")).alias("first"), F.count(F.lit(1)).alias("n"))
            _stream(spark, counted, f"{root}/state", lambda w: w.outputMode("update").foreachBatch(keep))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    if not exists(spark, hits_at):
        return spark.createDataFrame([], "doc_id long, duplicate_of long, digest string")
    # a digest's last hit knows all of its rows so far
    found = spark.read.schema("digest binary, first struct<id: long, file: string, row: long>, n long, batch int").parquet(hits_at).where(F.col("batch") > before)
    hits = found.groupBy("digest").agg(F.max_by(F.struct("first", "n"), "batch").alias("h")).select("digest", "h.first", "h.n")
    n_hits, n_members = (int(x or 0) for x in hits.agg(F.count(F.lit(1)), F.sum("n")).first())
    rows = spark.read.schema(_LOCATOR).parquet(locators)
    member = with_keys(rows, hits, ["digest"], "n", rows.count()).where((F.col("file") != F.col("first.file")) | (F.col("row") != F.col("first.row")))
    part = F.floor(F.pmod(F.xxhash64("file", "row"), F.greatest(F.ceil(F.col("n") / PART_ROWS), F.lit(1)))).cast("int")
    copies = fetch(member.select("digest", part.alias("part"), F.col("first.id").alias("first_id"), "id", "file", "row"), n_members)
    kept = fetch(hits.select("digest", "n", F.col("first.file").alias("file"), F.col("first.row").alias("row")), n_hits)
    kept = kept.select("digest", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / PART_ROWS), F.lit(1)).cast("int") - 1)).alias("part"), F.col("text").alias("kept_text"))
    pairs = copies.join(kept.hint("merge"), ["digest", "part"])
    other = F.when(F.col("text") != F.col("kept_text"), F.col("text")).alias("other")
    judged = written(pairs.select("digest", "first_id", "id", "file", "row", other), "exact-judged")
    # rows of the digest but with other bytes are told apart by their bytes; only a collision makes any
    same = Window.partitionBy("digest", "other").orderBy("id", "file", "row")
    apart = judged.where("other IS NOT NULL").select("digest", F.first("id").over(same).alias("first_id"), "id", F.row_number().over(same).alias("nth")).where("nth > 1").drop("nth")
    every = judged.where("other IS NULL").select("digest", "first_id", "id").unionByName(apart)
    nameless = lambda c: F.nullif(F.col(c), F.lit(LAST))
    return every.select(nameless("id").alias("doc_id"), nameless("first_id").alias("duplicate_of"), F.lower(F.hex("digest")).alias("digest"))


def exact_dedup(docs: DataFrame, **kw) -> DataFrame:
    """``exact_dedup_path`` over a DataFrame with doc_id and text: it is written to the shared folder and streamed from there."""
    path = shared_dir(docs.sparkSession, "exact-in")
    docs.select("doc_id", "text").write.parquet(path)
    return exact_dedup_path(docs.sparkSession, path, **kw)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup_path(spark, f"{sf_dir}/documents.parquet")


SQL = {
    "op5_exact_dedup": """
SELECT doc_id, first_value(doc_id) OVER w AS duplicate_of, sha256(text) AS digest
FROM documents WHERE text IS NOT NULL
WINDOW w AS (PARTITION BY text ORDER BY doc_id NULLS LAST)
QUALIFY row_number() OVER w > 1
"""
}
