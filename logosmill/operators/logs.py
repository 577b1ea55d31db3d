"""Training logs: points, smoothing, checkpoints, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The shapes of progress and validation lines.
PROGRESS = r"(\d+)/\d+[^\n]*?loss=([0-9.]+),\s*lr=([0-9.e\-+]+)"
VALIDATION = r"\[Step\s+(\d+)\]\s+Validation Loss:\s+([0-9.]+)\s+\|\s+Perplexity:\s+([0-9.]+)"


def _points(df: DataFrame, keys: list[str], text: str, pattern: str, names: tuple[str, str, str]) -> DataFrame:
    parts = [F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(i)) for i in (1, 2, 3)]
    rows = df.where(F.col(text).isNotNull()).select(*keys, F.posexplode(F.arrays_zip(*[p.alias(n) for p, n in zip(parts, names)])).alias("nth", "p"))
    a, b, c = names
    number = lambda x: F.expr(f"try_cast(p.`{x}` as double)").alias(x)
    return rows.select(*keys, (F.col("nth") + 1).cast("bigint").alias("nth"), F.expr(f"try_cast(p.`{a}` as bigint)").alias(a), number(b), number(c))


def progress_points(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(step, loss, lr) of every progress mark, numbered within its row; nulls and other lines have none."""
    return _points(df, keys, text, PROGRESS, ("step", "loss", "lr"))


def validation_points(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(step, loss, ppl) of every validation mark; marks with ``nan`` are none."""
    return _points(df, keys, text, VALIDATION, ("step", "loss", "ppl"))


def moving_average(df: DataFrame, run: str, order: list[str], value: str, window: int = 10) -> DataFrame:
    """``smooth``: the mean of the last ``window`` values of the run; the first window - 1 rows repeat the first value, and a shorter run stays as it is."""
    w = Window.partitionBy(run).orderBy(*order)
    whole = Window.partitionBy(run)
    i, n = F.row_number().over(w), F.count("*").over(whole)
    mean = F.avg(value).over(w.rowsBetween(-(window - 1), 0))
    return df.withColumn("smooth", F.when(n < window, F.col(value)).when(i < window, F.first(value).over(w)).otherwise(mean))


def best_checkpoints(df: DataFrame, run: str, order: list[str], loss: str) -> DataFrame:
    """Rows whose loss is strictly below all before it in the run; the first row is one."""
    before = F.min(loss).over(Window.partitionBy(run).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_b", before).where(F.col("_b").isNull() | (F.col(loss) < F.col("_b"))).drop("_b")


def loss_summary(df: DataFrame, run: str, order: str, loss: str) -> DataFrame:
    """First, least, greatest and last loss of each run."""
    return df.groupBy(run).agg(F.min_by(loss, order).alias("initial"), F.min(loss).alias("lowest"), F.max(loss).alias("highest"), F.max_by(loss, order).alias("current"), F.count("*").alias("points"))


def every(df: DataFrame, step: str, n: int) -> DataFrame:
    return df.where(F.col(step) % n == 0)
