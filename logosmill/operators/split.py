"""Shuffle and split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import ranked_total


def split_lines(df: DataFrame, key: str = "hash", seed: int = 42, share: float = 0.025, least: int = 100) -> DataFrame:
    """``split`` (train, val, test) and ``rank`` of each row in a random but reproducible order of ``key``.

    val and test have max(least, int(share n)) rows each, train the rest.
    With fewer than 2 * least rows the parts would overlap: val and test then
    share the rows evenly and train is empty. All columns are written once;
    where lines are long, split their keys and join the lines back.
    """
    rows, n = ranked_total(df.withColumn("_k", F.md5(F.concat(F.lit(f"{seed}|"), F.col(key)))), ["_k", key])
    rows = rows.drop("_k")
    part = min(max(least, int(n * share)), n // 2)
    train = n - 2 * part
    return rows.withColumn("split", F.when(F.col("rank") <= train, "train").when(F.col("rank") <= train + part, "val").otherwise("test"))


def dataset_stats(df: DataFrame, min_words: int = 3, max_words: int = 40, min_ratio: float = 0.85) -> DataFrame:
    """One row: totals of all splits, and the limits of the cleaning."""
    each = [F.sum((F.col("split") == s).cast("bigint")).alias(f"{s}_lines") for s in ("train", "val", "test")]
    return df.agg(F.count("*").alias("total_lines"), *each).select(
        "total_lines", *[F.coalesce(f"{s}_lines", F.lit(0)).cast("bigint").alias(f"{s}_lines") for s in ("train", "val", "test")],
        F.lit(min_words).alias("min_words_per_line"), F.lit(max_words).alias("max_words_per_line"), F.lit(min_ratio).alias("min_greek_ratio"),
    )
