"""The folder that all executors share, and small files on whatever file system a path names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below spark.checkpoint.dir.

    Only in local mode, as in tests, an unset folder is replaced by a temporary one; on a cluster it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: what is computed once stays so, whichever executor is lost."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """With the columns, each worked out once a row whatever refers to it: unlike a projection, a generator of one row is not copied into the expressions above it."""
    return df.select(*(F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c not in columns), F.inline(F.array(F.struct(*(v.alias(k) for k, v in columns.items())))))


class Files:
    """A few operations of the Hadoop file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        fs = self._path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        # local files without checksums beside them, which another program's change would belie
        self.fs = fs.getRawFileSystem() if fs.getScheme() == "file" else fs

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def rename(self, old: str, new: str) -> None:
        if not self.fs.rename(self._path(old), self._path(new)):
            raise OSError(f"can't rename {old} to {new}")

    def remove(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def read(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Written beside it, then renamed: nobody reads half a file."""
        part = f"{path}.part-{uuid.uuid4().hex}"
        out = self.fs.create(self._path(part), True)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        if self.exists(path):
            self.remove(path)
        self.rename(part, path)
