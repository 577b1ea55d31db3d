"""Exact deduplication by hash, priorities between sources, caps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.shared import written
from .ranking import first_rows


def keep_first(df: DataFrame, order: list[str], line_col: str = "line") -> DataFrame:
    """The first row of every distinct line, by ``order``; adds ``hash``. Copies are cut within partitions before the shuffle."""
    w = Window.partitionBy("hash").orderBy(*order)
    return df.withColumn("hash", F.md5(line_col)).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def process_stream(df: DataFrame, order: list[str], cap: int | None = None, seen: DataFrame | None = None, line_col: str = "line") -> DataFrame:
    """Distinct cleaned lines not in ``seen`` (a table with ``hash``), at most ``cap`` of them in order (0 and None: all)."""
    return _unseen(keep_first(df, order, line_col), order, cap, seen)


def _unseen(rows: DataFrame, order: list[str], cap: int | None, seen: DataFrame | None) -> DataFrame:
    if seen is not None:
        rows = rows.join(seen.select("hash"), "hash", "left_anti")
    return first_rows(rows, order, cap) if cap else rows


def priority_keys(sources: list[tuple[DataFrame, int | None]], order: list[str], line_col: str = "line") -> DataFrame:
    """Kept lines without their text (the other columns and ``hash``), of sources in order of priority, each with its cap.

    A line beyond an earlier source's cap was never seen, so a later source may still give it. Hashes and order alone are
    shuffled, ranked and written.
    """
    w = Window.partitionBy("hash").orderBy(*order)
    kept = None
    for df, cap in sources:
        keys = df.withColumn("hash", F.md5(line_col)).drop(line_col)
        first = keys.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
        part = written(_unseen(first, order, cap, kept), "dedup")
        kept = part if kept is None else kept.unionByName(part)
    return kept


def priority_dedup(sources: list[tuple[DataFrame, int | None]], order: list[str], line_col: str = "line") -> DataFrame:
    """``priority_keys`` with the lines, which one join on ``order`` (it must tell all rows apart) brings back."""
    keys = priority_keys(sources, order, line_col)
    lines = sources[0][0]
    for df, _ in sources[1:]:
        lines = lines.unionByName(df)
    texts = lines.select(*order, line_col).join(keys.select(*order), order, "left_semi").dropDuplicates(order)
    return keys.join(texts, order)
