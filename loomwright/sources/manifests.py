"""JSON-lines manifests: strict and lenient scans that keep each raw line, and writers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomwright.functions.tables import written
from loomwright.functions.text import manifest_path, unsafe_path
from loomwright.operators.manifests import unique_keys


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line, raw`` of each non-blank line, 1-based within its file, with the file's ``path``; large files are read in splits.

    The lines of a split are numbered in its task; how many lines the splits
    before it hold are sums over one row a split.
    """
    text = spark.read.text(path)
    meta = text.metadataColumn("_metadata")
    placed = text.select("value", meta["file_path"].alias("path"), meta["file_block_start"].alias("begin"), F.monotonically_increasing_id().alias("at"))
    rows = written(placed)  # once: another read could be split anew
    splits = rows.groupBy("path", "begin").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(Window.partitionBy("path").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1))
    offsets = splits.select("path", "begin", (F.coalesce(before, F.lit(0)) - F.col("first") + 1).alias("offset"))
    numbered = rows.join(offsets, ["path", "begin"]).select("path", (F.col("at") + F.col("offset")).alias("line"), F.trim("value").alias("raw"))
    return numbered.where("raw <> ''")


def discover(spark: SparkSession, folder: str, pattern: str = "*.jsonl") -> str:
    """The one manifest of a folder; an error where there is none, or more than one."""
    found = [r["path"] for r in spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path").limit(3).collect()]
    if len(found) != 1:
        raise ValueError(f"one manifest {pattern} wanted in {folder}, found {len(found) if len(found) < 3 else 'more than two'}")
    return found[0]


def _parsed(lines: DataFrame) -> DataFrame:
    tree = F.try_parse_json("raw")
    kind = F.schema_of_variant(tree)
    get = lambda k, t: F.try_variant_get(tree, f"$.{k}", t)
    return lines.select("*", tree.alias("tree"), kind.alias("kind"), get("audio", "string").alias("audio"), get("text", "string").alias("text"), get("duration", "double").alias("duration"))


def scan(spark: SparkSession, path: str) -> DataFrame:
    """``path, line, raw, audio, text, duration, problem`` of each record; null ``problem`` for a sound one."""
    rows = _parsed(read_lines(spark, path))
    problem = (
        F.when(F.col("tree").isNull(), "invalid JSON")
        .when(~F.col("kind").startswith("OBJECT"), "not an object")
        .when(F.coalesce("audio", F.lit("")) == "", "missing audio")
        .when(unsafe_path(F.col("audio")), "unsafe path")
    )
    return rows.select("path", "line", "raw", manifest_path(F.col("audio")).alias("audio"), "text", "duration", problem.alias("problem"))


def with_missing(rows: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """Records of a scan; a sound one whose audio is none of ``files`` (``path``) under ``root`` gets the problem ``missing file`` (Spark lists no file without bytes)."""
    base = re.escape(root.rstrip("/"))
    there = files.select(F.regexp_replace("path", f"^.*?{base}/", "").alias("_there")).distinct()
    both = rows.join(there, F.col("audio") == F.col("_there"), "left")
    return both.withColumn("problem", F.when(F.col("problem").isNull() & F.col("_there").isNull(), "missing file").otherwise(F.col("problem"))).drop("_there")


def scan_strict(spark: SparkSession, path: str, root: str | None = None) -> DataFrame:
    """:func:`scan`, but a manifest without records is refused, and any faulty record fails the job when it is read.

    With ``root``, the folder of the audio files, a file that is not there is
    a fault too.
    """
    rows = scan(spark, path)
    if root is not None:
        rows = with_missing(rows, spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path"), root)
    if rows.isEmpty():
        raise ValueError(f"{path} holds no records")
    message = F.concat(F.lit("line "), F.col("line").cast("string"), F.lit(": "), F.col("problem"))
    return rows.withColumn("audio", F.when(F.col("problem").isNull(), F.col("audio")).otherwise(F.raise_error(message).cast("string"))).drop("problem")


def scan_lenient(spark: SparkSession, path: str, key: str = "audio") -> DataFrame:
    """Records with a ``unique_key``: the key field, ``_line:n`` without one, ``key#n`` for the n-th of equals."""
    rows = _parsed(read_lines(spark, path)).where(F.col("kind").startswith("OBJECT"))
    value = F.col("line").cast("string") if key == "_line" else F.coalesce(F.try_variant_get("tree", f"$.{key}", "string"), F.concat(F.lit("_line:"), F.col("line").cast("string")))
    return unique_keys(rows.withColumn("key", value), "key", ["path", "line"]).drop("tree", "kind")


def write_jsonl(rows: DataFrame, path: str, columns: list[str], order: list[str], mode: str = "errorifexists") -> None:
    """One JSON object a line in the given order; an existing output is refused unless ``mode`` says otherwise."""
    fields = [F.round(c, 3).alias(c) if t == "double" else F.col(c) for c, t in rows.select(*columns).dtypes]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    sorted_.select(F.to_json(F.struct(*fields)).alias("value")).write.mode(mode).text(path)


def write_tsv(rows: DataFrame, path: str, columns: list[str], order: list[str], mode: str = "errorifexists") -> None:
    """Tab-separated with a header, doubles with three decimals, in the given order."""
    fields = [F.format_string("%.3f", c).alias(c) if t == "double" else F.col(c) for c, t in rows.select(*columns).dtypes]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select(*fields).write.mode(mode).option("sep", "\t").option("header", True).csv(path)


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("sep", "\t").option("header", True).schema(schema).csv(path)
