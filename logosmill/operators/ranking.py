"""Global ranks without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.shared import written


def global_rank(df: DataFrame, order: list[str | Column], name: str = "rank") -> DataFrame:
    """Rows numbered from 1 in ``order`` (which must tell all rows apart)."""
    return ranked_total(df, order, name)[0]


def ranked_total(df: DataFrame, order: list[str | Column], name: str = "rank") -> tuple[DataFrame, int]:
    """``global_rank``, and the number of rows.

    Range partitions are sorted and written with their number; their sizes give
    offsets (one row a partition), a window within each partition the rest.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = written(df.repartitionByRange(parts, *order).withColumn("_p", F.spark_partition_id()), "rank")
    sizes = rows.groupBy("_p").count()
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition only
    offsets = sizes.select("_p", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_o"))
    ranked = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    return ranked.join(F.broadcast(offsets), "_p").withColumn(name, F.col("_o") + F.col("_n")).drop("_p", "_o", "_n"), rows.count()


#: Up to so many rows are the head of a sort that keeps no more of them a task.
HEAD = 10_000


def first_rows(df: DataFrame, order: list[str | Column], n: int) -> DataFrame:
    """The first n rows in ``order``: a few by a bounded sort, many by their ranks."""
    if n <= HEAD:
        return df.orderBy(*order).limit(n)
    return global_rank(df, order, "_rank").where(F.col("_rank") <= n).drop("_rank")
