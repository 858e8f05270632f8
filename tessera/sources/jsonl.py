"""Scans of line-delimited and array JSON, with per-row verdicts, as lazy DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import materialised

#: What a scan makes of a line: blank lines and bad JSON are ignored, counted or an error.
MODES = ("tolerant", "strict", "semi", "skip")


def lines(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """(file, ord, value): every line below a path; ``ord`` rises within a file, so (file, ord) is a stable total order.

    The order key comes from the scan alone: no shuffle, no second read.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if not path.endswith((".jsonl", ".json", ".txt")):
        reader = reader.option("pathGlobFilter", glob)
    raw = reader.text(path)
    # block start, then the line's place in its split: both rise along the file
    return raw.select(F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")).alias("ord"), "value")


def decoded(scan: DataFrame, mode: str = "tolerant") -> DataFrame:
    """``scan`` with ``v`` (a variant) and ``reason``.

    tolerant: blank lines go; bad JSON is invalid_json, anything but an object
    invalid_record. strict: either is an error that names file and line. semi: bad
    JSON is an error, other values than objects go. skip: blank lines and bad JSON
    are bad_json, other values than objects are skipped.
    """
    if mode not in MODES:
        raise ValueError(f"mode {mode}; known: {MODES}")
    blank = ~F.col("value").rlike(r"(?U)\S")
    d = scan.where("value IS NOT NULL")
    if mode != "skip":
        d = d.where(~blank)
    d = d.withColumn("v", F.try_parse_json("value"))
    kind = F.schema_of_variant(F.col("v"))
    is_object = F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    where = F.concat(F.lit("bad line in "), F.col("file"), F.lit(" at "), F.to_json("ord"), F.lit(": "), F.substring("value", 1, 80)) if "file" in scan.columns else F.concat(F.lit("bad line: "), F.substring("value", 1, 80))
    fail = F.raise_error(where).cast("string")
    if mode == "tolerant":
        return d.withColumn("reason", F.when(F.col("v").isNull(), "invalid_json").when(~is_object, "invalid_record"))
    if mode == "strict":
        return d.withColumn("reason", F.when(F.col("v").isNull() | ~is_object, fail))
    if mode == "semi":
        return d.withColumn("reason", F.when(F.col("v").isNull(), fail)).where(F.col("reason").isNull() & is_object)
    return d.withColumn("reason", F.when(F.col("v").isNull(), "bad_json").when(~is_object, "skipped"))


def field(name: str, kind: str = "string", v: str = "v") -> Column:
    """A field of the variant; null if it is absent or of another kind."""
    return F.try_variant_get(F.col(v), f"$['{name}']" if not name.isidentifier() else f"$.{name}", kind)


def first_of(names, v: str = "v") -> Column:
    """The first field that is neither null nor an empty string, as a string; 0, false and [] count as present."""
    return F.coalesce(*(F.nullif(field(n, v=v), F.lit("")) for n in names), F.lit(None).cast("string"))


def json_array(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Rows of a file that is one JSON array. Such a file can't be split: convert it once with ``write.json``."""
    reader = spark.read.option("multiLine", "true")
    return (reader.schema(schema) if schema else reader).json(path)


def looks_like_array(spark: SparkSession, path: str) -> bool:
    """Whether the first character that isn't blank is a bracket; reads one line."""
    first = spark.read.text(path).where(F.regexp_replace("value", r"(?U)[\s\x{FEFF}]", "") != "").limit(1).collect()
    return bool(first) and first[0].value.lstrip("﻿ \t\r\n").startswith("[")


def records(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Array or lines, whichever the file is; bad lines of the latter are an error."""
    if looks_like_array(spark, path):
        return json_array(spark, path, schema)
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def array_to_lines(spark: SparkSession, source: str, target: str) -> None:
    """One pass from a JSON array to JSON lines; nulls are kept."""
    json_array(spark, source).write.option("ignoreNullFields", "false").json(target)


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows by order; n <= 0 means all."""
    return df if n <= 0 else df.orderBy(*order).limit(n)


def dense_ordinal(df: DataFrame, order: list[str], name: str = "row_id", parts: int | None = None) -> DataFrame:
    """With the row's 0-based place in the order.

    A range partitioning sorts in parallel; the partitions' sizes (one number each)
    are summed and joined back, so no single task sees all rows. The partitioned
    rows are written once: its bounds are sampled, so working them out twice could
    give two partitionings.
    """
    sort = materialised(df.repartitionByRange(*([parts] if parts else []), *order).withColumn("__p", F.spark_partition_id()), "ordinal")
    sizes = sort.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.withColumn("__before", F.sum("__n").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1))).select("__p", F.coalesce("__before", F.lit(0)).alias("__before"))
    local = F.row_number().over(Window.partitionBy("__p").orderBy(*order)) - 1
    return sort.withColumn("__i", local).join(before, "__p").withColumn(name, F.col("__before") + F.col("__i")).drop("__p", "__i", "__before")


def tsv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Tab-separated strings under given names."""
    return spark.read.option("sep", "\t").schema(", ".join(f"`{n}` string" for n in names)).csv(path)


def vocabulary(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """(token): the first field of each line, if all of it is CJK ideographs."""
    token = F.split("value", sep)[0]
    return spark.read.text(path).select(token.alias("token")).where(F.col("token").rlike("^[一-龥]*$"))


def chat_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(user, assistant): the first two turns of each chat of two turns at least."""
    c = spark.read.schema("conversations array<struct<from:string,value:string>>").json(path)
    return c.where(F.size("conversations") >= 2).select(F.col("conversations")[0]["value"].alias("user"), F.col("conversations")[1]["value"].alias("assistant"))
