"""Shared folder, tables, joins and Arrow helpers of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null identifier where a total order is needed; such rows come last.
LAST = 2**63 - 1
#: A key is hot if it has at least this part of all rows; so there are at most so many hot keys, which bounds what is broadcast.
HOT = 10_000
_made: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that the cluster names in spark.checkpoint.dir.

    Only in local mode, as in tests, an unset folder is replaced by a temporary one;
    on a cluster it is an error, as executors don't share a machine's own folders.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-"))
        base = spark.sparkContext.getCheckpointDir()
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path)."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def remove(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at)


@contextmanager
def scratch(spark: SparkSession):
    """What is written to the shared folder within is deleted at the end; give ``keep`` (a list) the paths that stay."""
    first, keep = len(_made), []
    yield keep
    for path in _made[first:]:
        if path not in keep:
            remove(spark, path)
    del _made[first:]


def written(df: DataFrame, name: str, keep: list[str] | None = None) -> DataFrame:
    """The rows, written to the shared folder and read again: lineage ends here and survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    if keep is not None:
        keep.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), so no other column can clash."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """The name, or one like it that no column has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_keys(rows: DataFrame, keys: DataFrame, on: list[str], n: str, total: int) -> DataFrame:
    """The inner join of many rows with unique keys, of which column ``n`` says how many rows each has, of ``total`` in all.

    Hot keys are broadcast: as their counts add up to ``total`` at most, there are
    ``HOT`` of them at most, whatever the input, and their rows stay where they are.
    The rest is joined by merge, where no key has more than a 10,000th of the rows.
    """
    cut = max(2, -(-total // HOT))
    hot, rest = keys.where(F.col(n) >= cut), keys.where(F.col(n) < cut)
    return rows.join(F.broadcast(hot), on).unionByName(rows.join(rest.hint("merge"), on))


def trim() -> None:
    """Freed memory goes back to the system: Python workers outlive their tasks, and stages of one application follow one another."""
    pa.default_memory_pool().release_unused()
    if release := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc has it
        release(0)


def trimmed(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """f for mapInArrow; ``trim`` follows its last batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        trim()

    return run


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """f over every Arrow batch; None adds nothing."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and (out := f(b)) is not None and out.num_rows:
                yield out

    return df.mapInArrow(trimmed(each), schema)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: sets the number of buckets, so that a bucket's size doesn't grow with the input."""
    return int(df.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0)


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def one_text_each(docs: DataFrame, ids: list[int], more: tuple[str, ...] = ()) -> pa.Table:
    """(doc_id, more, text) of the given ids, one row for each id and value of ``more``: repeated rows of an id can't make the fetch larger.

    For fits on bounded samples. Of several texts the smallest is taken.
    """
    spark = docs.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(i,) for i in ids], "doc_id long"))
    names = [F.col(c).cast("string").alias(c) for c in more]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *names, F.col("text").cast("string").alias("text")).where("text IS NOT NULL").join(wanted, "doc_id", "left_semi")
    return rows.groupBy("doc_id", *more).agg(F.min("text").alias("text")).toArrow()
