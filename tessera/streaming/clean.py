"""The cleaning plan over a stream of line files: every micro-batch is classified and appended, keys once kept stay known."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import pair_key
from ..plans.clean import classify
from ..plans.config import Cleaning
from ..sources.shared import Files


def clean_stream(spark: SparkSession, source: str, target: str, checkpoint: str, cfg: Cleaning = Cleaning(), available_now: bool = True):
    """Start a query that appends the kept pairs of new files below ``source`` to Parquet at ``target``.

    Within a batch keep-first holds; a pair kept by an earlier batch is found by an
    anti-join on the keys written so far. A batch that is run again after a failure
    overwrites only its own partition.
    """
    lines = spark.readStream.schema("value string").option("recursiveFileLookup", "true").text(source).select(F.col("_metadata.file_path").alias("file"), "value")

    files = Files(spark, target)

    def append(batch: DataFrame, number: int) -> None:
        scan = batch.select("file", F.struct(F.lit(0).cast("long").alias("block"), F.monotonically_increasing_id().alias("n")).alias("ord"), "value")
        kept = classify(scan, cfg).where("reason IS NULL AND kind = 'single'").select("instruction", "input", "output")
        question = F.when(F.col("input") != "", F.col("input")).otherwise(F.col("instruction"))
        kept = kept.withColumn("key", pair_key(question, F.col("output")))
        if files.exists(target):  # the first batch has nothing to read
            known = spark.read.schema("key string, batch int").parquet(target).where(F.col("batch") < number).select("key")
            kept = kept.join(known, "key", "left_anti")
        kept.write.mode("overwrite").parquet(f"{target}/batch={number}")

    writer = lines.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
