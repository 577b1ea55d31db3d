"""Problem 5: mixing sources to target weights.

Every record gets a hash-random key. Records are ordered by key within their
source; the key's leading bits are ranges of equal expected size, so a source
of any size spreads over many ranges. Sums of the ranges give each range its
offset, a running sum within the range the rest: a distributed prefix sum. A
source's budget is so many whole epochs and then the records up to the exact
cut; the record at the cut is in if that comes nearer to the budget.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .textnorm import CharBatch, slices, to_string_array

RANGE_ROWS = 20_000
UNITS = ("words", "chars", "records")


def record_sizes(df: DataFrame, id_col: str = "rec_id", source_col: str = "source_name", text_col: str = "text") -> DataFrame:
    """(id, source, words, chars, records) of each record with text, redelivered rows once. Words as in the consistent form, characters as delivered."""
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.where((F.col(text_col) != "") & F.col(id_col).isNotNull() & F.col(source_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("t"))

    def run(batches):
        for batch in batches:
            arr = to_string_array(batch.column(2))
            for a, b in slices(arr):
                part = arr.slice(a, b - a)
                cb = CharBatch(part)
                words = np.bincount(cb.word_row, minlength=b - a).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(words), pa.compute.utf8_length(part).cast(pa.int64())], ["id", "source", "words", "chars"])

    sizes = rows.mapInArrow(run, f"id {kind}, source string, words bigint, chars bigint")
    return sizes.groupBy("source", "id").agg(F.max("words").alias("words"), F.max("chars").alias("chars")).withColumn("records", F.lit(1).cast("bigint"))


def prefix_sums(sizes: DataFrame, seed: int = 20240607, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``sizes`` with before_<unit>: the sum of the unit over the records of the source whose key is less (ties by id)."""
    rows = sizes.count()
    ranges = 1
    while ranges * range_rows < rows:
        ranges *= 2
    key = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("id").cast("string"))), 1, 15), 16, 10).cast("bigint")
    keyed = sizes.withColumn("key", key).withColumn("range", F.expr(f"cast(key div {(1 << 60) // ranges}L as int)"))
    sums = keyed.groupBy("source", "range").agg(*[F.sum(u).alias(f"s_{u}") for u in UNITS])
    w = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source", "range", *[F.coalesce(F.sum(f"s_{u}").over(w), F.lit(0)).alias(f"o_{u}") for u in UNITS])
    inner = Window.partitionBy("source", "range").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, -1)
    run = keyed.select("*", *[F.coalesce(F.sum(u).over(inner), F.lit(0)).alias(f"r_{u}") for u in UNITS])
    return run.join(offsets, ["source", "range"]).select("id", "source", *UNITS, *[(F.col(f"o_{u}") + F.col(f"r_{u}")).alias(f"before_{u}") for u in UNITS])


def budgets(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per mix and source: budget, whole epochs and what is left for the last, partial one. Sources without records have size 0."""
    per = sizes.groupBy("source").agg(*[F.sum(u).alias(u) for u in UNITS])
    unit = lambda t: F.expr(f"case size_unit when 'words' then {t}words when 'chars' then {t}chars else {t}records end")
    total = per.agg(*[F.sum(u).alias(f"all_{u}") for u in UNITS])
    t = targets.select("mix_id", F.col("source_name").alias("source"), "target_share", "max_repeats", "size_unit", "total_factor").distinct()
    out = t.join(F.broadcast(total)).join(F.broadcast(per), "source", "left").fillna(0, list(UNITS))
    out = out.select("mix_id", "source", "target_share", "max_repeats", "size_unit", unit("").alias("source_size"), (F.col("total_factor") * unit("all_")).alias("mix_size"))
    out = out.withColumn("budget", F.col("mix_size") * F.col("target_share"))
    out = out.withColumn("epochs", F.expr("case when source_size = 0 then 0 else least(cast(max_repeats as bigint), cast(floor(budget / source_size) as bigint)) end"))
    return out.withColumn("rest", F.expr("case when epochs >= max_repeats then 0.0D else budget - epochs * source_size end"))


def mix_sources(df: DataFrame, targets: DataFrame, seed: int = 20240607) -> tuple[DataFrame, DataFrame]:
    """(usage, shares) of every mix.

    usage: mix_id, source_name, rec_id, times (0 up to max_repeats), one row per
    mix and record with text. shares: mix_id, source_name, target_share,
    actual_share (of what the mix really holds), budget, actual_size,
    max_used. Null and empty texts, null ids and null sources are no records; a source without records
    has share 0. ``targets`` is small (a bounded table of mixes).
    """
    sizes = written(record_sizes(df), "mix-sizes")
    budget = written(budgets(sizes, targets), "mix-budgets")
    rows = prefix_sums(sizes, seed).join(F.broadcast(budget.select("mix_id", "source", "size_unit", "epochs", "rest", "max_repeats")), "source")
    pick = lambda t: F.expr(f"case size_unit when 'words' then {t}words when 'chars' then {t}chars else {t}records end")
    rows = rows.withColumn("size", pick("")).withColumn("before", pick("before_"))
    more = (F.col("epochs") < F.col("max_repeats")) & (F.col("before") + F.col("size") / 2 <= F.col("rest")) & (F.col("rest") > 0)
    usage = rows.select("mix_id", F.col("source").alias("source_name"), F.col("id").alias("rec_id"), (F.col("epochs") + more.cast("bigint")).cast("int").alias("times"), "size")
    used = usage.groupBy("mix_id", "source_name").agg(F.sum(F.col("times") * F.col("size")).alias("actual_size"), F.max("times").alias("max_used"))
    shares = budget.withColumnRenamed("source", "source_name").join(used, ["mix_id", "source_name"], "left").fillna(0, ["actual_size", "max_used"])
    whole = shares.groupBy("mix_id").agg(F.sum("actual_size").alias("whole"))
    shares = shares.join(F.broadcast(whole), "mix_id").select(
        "mix_id", "source_name", "size_unit", "target_share", (F.col("actual_size") / F.greatest(F.col("whole"), F.lit(1))).alias("actual_share"), "budget", "actual_size", (F.col("actual_size") / F.greatest(F.col("mix_size"), F.lit(1e-9))).alias("share_of_target_size"), "max_used",
    )
    return usage.drop("size"), shares
