"""Readers. Each gives lines with an explicit order: (source, priority, doc_id, line_no, line)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip


def split_lines(df: DataFrame, id_col: str, text: Column, source: str, priority: int) -> DataFrame:
    """The non-blank lines of multi-line texts, stripped; null texts have none."""
    rows = df.select(F.lit(source).alias("source"), F.lit(priority).alias("priority"), F.col(id_col).alias("doc_id"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    return rows.select("source", "priority", "doc_id", (F.col("line_no") + 1).cast("bigint").alias("line_no"), strip(F.col("line")).alias("line")).where("line <> ''")


def sentence_pairs(df: DataFrame, id_col: str, source: str, priority: int, language: str = "el") -> DataFrame:
    """One side of parallel sentences, neither stripped nor split; null and empty ones drop out."""
    text = F.col(f"translation.{language}")
    return df.where(text != "").select(F.lit(source).alias("source"), F.lit(priority).alias("priority"), F.col(id_col).alias("doc_id"), F.lit(1).cast("bigint").alias("line_no"), text.alias("line"))


def read_lines(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """Non-blank lines of text files, stripped, with their file (``file``, ``line``). Broken bytes drop out."""
    mark, hidden = F.lit("\ufffd"), F.lit("\ufdd0")  # what stands for broken bytes, and what keeps such marks of the file apart
    text = F.replace(F.replace(F.make_valid_utf8(F.replace("value", mark, hidden)), mark, F.lit("")), hidden, mark)
    raw = spark.read.option("pathGlobFilter", pattern).text(path).select(F.col("_metadata.file_path").alias("file"), strip(text).alias("line"))
    return raw.where("line <> ''")


def read_json_lines(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> DataFrame:
    """Lines of the ``text`` of JSON records, one record a line; malformed records and records without text drop out."""
    raw = spark.read.option("pathGlobFilter", pattern).text(path).select(F.col("_metadata.file_path").alias("file"), F.from_json("value", "text string").alias("r"))
    return raw.where("r.text is not null").select("file", F.explode(F.split("r.text", "\n")).alias("line")).select("file", strip(F.col("line")).alias("line")).where("line <> ''")


def read_raw_folder(spark: SparkSession, path: str) -> DataFrame:
    """All local raw files: text files, then JSON files."""
    return read_lines(spark, path).withColumn("kind", F.lit(1)).unionByName(read_json_lines(spark, path).withColumn("kind", F.lit(2)))


def parse_json_lines(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """As read_json_lines, from a column."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.from_json(json_col, "text string").alias("r")).where("r.text is not null")
    return rows.select("doc_id", F.posexplode(F.split("r.text", "\n")).alias("line_no", "line")).select("doc_id", (F.col("line_no") + 1).cast("bigint").alias("line_no"), strip(F.col("line")).alias("line")).where("line <> ''")


def read_samples(spark: SparkSession, path: str, most: int | None = 500) -> DataFrame:
    """Records of a correction benchmark (JSON, one a line); the first ``most`` in the order of the files."""
    schema = "context string, corrupted_word string, target_word string, error_type string, full_sequence string"
    rows = spark.read.schema(schema).json(path)
    if not most:
        return rows
    place = [F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"), F.monotonically_increasing_id().alias("_i")]
    return rows.select("*", *place).orderBy("_f", "_b", "_i").limit(most).drop("_f", "_b", "_i")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A whole training log as one value."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The models of a JSON manifest, one row each."""
    raw = spark.read.option("multiLine", True).json(path)
    return raw.select(F.col("name").alias("catalogue"), "version", F.explode("models").alias("m")).select("catalogue", "version", "m.*")


def fallback_lines(spark: SparkSession, sentences: list[str], count: int, seed: int = 42) -> DataFrame:
    """(seq, line): ``count`` picks from a list of sentences, by hash of their number."""
    pool = F.array(*[F.lit(s) for s in sentences])
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("id").cast("string"))), 1, 8), 16, 10).cast("bigint")
    return spark.range(count).select(F.col("id").alias("seq"), F.element_at(pool, (draw % len(sentences)).cast("int") + 1).alias("line"))


def or_fallback(lines: DataFrame, sentences: list[str], count: int, seed: int = 42) -> DataFrame:
    """The lines, or where there are none ``count`` picks from the sentences."""
    return lines if not lines.isEmpty() else fallback_lines(lines.sparkSession, sentences, count, seed)
