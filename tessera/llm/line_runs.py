"""Line deduplication over levelled sorted runs of line hashes.

Documents come in batches. The line hashes of a batch are merge-anti-joined
with the live runs (tables bucketed and sorted on the hash, so a run is never
shuffled again) and those that are new become a run of level 0. When a level
holds ``fanout`` runs they are compacted into one of the next level: a hash is
rewritten once per level, log(batches) times in all.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LAST, id_text, remove, shared_dir, table, union

_BLANK = " \t\r"
#: A bucketed scan reports the order of its files where each bucket is one file.
_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def _trim(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANK))


class SortedRuns:
    """The levels. ``add`` is one batch; ``rows`` are all first occurrences so far (h1, h2, id, t, pos).

    A run has one file a bucket, sorted by the hash, and its scan says so, so a join
    neither shuffles nor sorts it. Tables are only named in the catalogue while
    batches are added (``close`` takes the names away); a compacted run's files go.
    """

    def __init__(self, spark: SparkSession, fanout: int = 4, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []

    def _store(self, rows: DataFrame, level: int) -> None:
        name, path = f"line_run_{uuid.uuid4().hex}", shared_dir(self.spark, "line-run")
        old = self.spark.conf.get(_ORDERED, None)
        self.spark.conf.set(_ORDERED, "true")
        try:
            rows.write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", path).saveAsTable(name)
        finally:
            self.spark.conf.unset(_ORDERED) if old is None else self.spark.conf.set(_ORDERED, old)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append((name, path))

    def new(self, firsts: DataFrame) -> DataFrame:
        """Those whose hash no run has."""
        for name, _ in [run for level in self.levels for run in level]:
            firsts = firsts.join(self.spark.table(name).select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        return firsts

    def add(self, firsts: DataFrame) -> None:
        self._store(self.new(firsts), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            runs = self.levels[level]
            merged = union([self.spark.table(n) for n, _ in runs]).repartition(self.buckets, "h1", "h2")
            self._store(merged, level + 1)
            self.levels[level] = []
            for name, path in runs:
                self.spark.sql(f"DROP TABLE {name}")
                remove(self.spark, path)
            level += 1

    def close(self) -> DataFrame:
        """``rows`` of the files alone."""
        runs = [run for level in self.levels for run in level]
        out = union([self.spark.read.schema(self.spark.table(n).schema).parquet(p) for n, p in runs])
        for name, _ in runs:
            self.spark.sql(f"DROP TABLE {name}")
        return out


def line_dedup(docs: DataFrame, batches: int = 4, fanout: int = 2) -> DataFrame:
    """(doc_id, text, n_lines, n_removed): each document without the lines that came earlier.

    Lines are compared without surrounding spaces, tabs and CR. Of equal lines the
    first by (doc_id, line number) stays, everywhere in the corpus; a null doc_id
    comes last. Blank lines always stay and a text's other lines keep their order.
    Rows of equal doc_id and text count as one document: a repeated row gets the same
    verdict. Rows of one doc_id (or without any) but other texts are told apart and
    ordered by a hash of the text.
    A null text stays null with 0 lines. Batches are doc_id ranges of about equal
    size; the result doesn't depend on their number.
    """
    spark = docs.sparkSession
    texts = id_text(docs)
    named = lambda d: d.withColumn("key", F.coalesce("doc_id", F.lit(LAST))).withColumn("t", F.xxhash64("text"))
    cuts = texts.select("doc_id").approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01) if batches > 1 else []
    edges = [None, *sorted({int(c) for c in cuts if c < 2**62}), None]
    runs = SortedRuns(spark, fanout)
    for low, high in zip(edges, edges[1:], strict=False):
        # on the bare column, so that the scan skips files and row groups of other batches
        part = texts
        if low is not None:
            part = part.where((F.col("doc_id") > low) if high is not None else (F.col("doc_id") > low) | F.col("doc_id").isNull())
        if high is not None:
            part = part.where(F.col("doc_id") <= high)
        lines = named(part).select("key", "t", F.posexplode(F.split("text", "\n")).alias("pos", "line")).select("key", "t", "pos", _trim(F.col("line")).alias("line")).where("line != ''")
        # two independent 64-bit hashes: 128 bits keep collisions out of reach at 10^12 lines
        firsts = lines.groupBy(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2")).agg(F.min(F.struct("key", "t", "pos")).alias("first"))
        runs.add(firsts.select("h1", "h2", F.col("first.key").alias("id"), F.col("first.t").alias("t"), F.col("first.pos").alias("pos")))
    kept = runs.close().groupBy("id", "t").agg(F.collect_list("pos").alias("kept"))
    lines = F.split("text", "\n")

    def rebuilt(s: Column) -> Column:
        blanks = F.filter(F.sequence(F.lit(0), F.size(s["lines"]) - 1), lambda i: _trim(F.element_at(s["lines"], i + 1)) == "")
        return F.array_join(F.transform(F.array_sort(F.concat(s["kept"], blanks)), lambda p: F.element_at(s["lines"], p + 1)), "\n")

    # the array of one struct binds the split lines once, outside of the inner lambdas
    text = F.transform(F.array(F.struct(lines.alias("lines"), F.coalesce("kept", F.array().cast("array<int>")).alias("kept"))), rebuilt)[0]
    n = F.coalesce(F.size(F.filter(lines, lambda x: _trim(x) != "")), F.lit(0))
    n = F.when(F.col("text").isNull(), 0).otherwise(n)
    k = F.coalesce(F.size("kept"), F.lit(0))
    return named(texts).join(kept.withColumnRenamed("id", "key"), ["key", "t"], "left").select(
        "doc_id", F.when(F.col("text").isNull() | (n == k), F.col("text")).otherwise(text).alias("text"), n.cast("long").alias("n_lines"), (n - k).cast("long").alias("n_removed")
    )


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))


SQL = {
    "op1_line_dedup": """
WITH l AS (
  SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS line FROM documents
), t AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS bare FROM l
), f AS (
  SELECT *, row_number() OVER (PARTITION BY bare ORDER BY doc_id NULLS LAST, pos) AS nth FROM t
), g AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE bare = '' OR nth = 1) AS kept,
         count(*) FILTER (WHERE bare <> '') AS n_lines, count(*) FILTER (WHERE bare <> '' AND nth > 1) AS n_removed
  FROM f GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(g.kept, '') END AS text,
       coalesce(g.n_lines, 0)::BIGINT AS n_lines, coalesce(g.n_removed, 0)::BIGINT AS n_removed
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id
"""
}
