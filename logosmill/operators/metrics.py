"""Metrics of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as X
from ..functions.text import let, perplexity, softmax, strip_accents, words


def top_k(df: DataFrame, id_col: str, logits_col: str, k: int = 5, masked: int = 0) -> DataFrame:
    """(id, rank, token, prob): the k likeliest tokens; ties by the lower token. Token numbers below ``masked`` are left out before the softmax."""
    kept = F.slice(F.col(logits_col), masked + 1, F.greatest(F.size(logits_col) - masked, F.lit(0)))
    rows = df.select(F.col(id_col), softmax(kept).alias("p"))
    pairs = F.array_sort(F.transform("p", lambda x, i: F.struct((-x).alias("np"), (i + masked).alias("token"))))
    return rows.select(id_col, F.posexplode(F.slice(pairs, 1, k)).alias("rank", "x")).select(id_col, (F.col("rank") + 1).alias("rank"), "x.token", (-F.col("x.np")).alias("prob"))


def argmax(df: DataFrame, id_col: str, logits_col: str) -> DataFrame:
    """(id, token) with the greatest logit, the lowest number on a tie."""
    return df.select(id_col, (F.array_position(logits_col, F.array_max(logits_col)) - 1).alias("token"))


def hit_rates(df: DataFrame, logits_col: str, target_col: str, ks: tuple[int, ...] = (1, 3, 5, 10)) -> DataFrame:
    """One row: positions, cross entropy by position, perplexity, and hit rates at each k (rank = how many logits are greater, plus the equal ones before it)."""
    target = F.element_at(F.col(logits_col), F.col(target_col) + 1)
    rows = df.select(target.alias("t"), F.col(logits_col).alias("x"), F.col(target_col).alias("y"))
    rank = F.size(F.filter("x", lambda v, i: (v > F.col("t")) | ((v == F.col("t")) & (i < F.col("y"))))) + 1
    loss = let(F.array_max("x").cast("double"), lambda m: F.log(F.aggregate("x", F.lit(0.0), lambda a, v: a + F.exp(v.cast("double") - m))) + m) - F.col("t").cast("double")
    rows = rows.select(rank.alias("rank"), loss.alias("loss"))
    n = F.greatest(F.count("*"), F.lit(1))
    out = rows.agg(F.count("*").alias("test_tokens"), (F.coalesce(F.sum("loss"), F.lit(0.0)) / n).alias("cross_entropy_loss"), *[(F.coalesce(F.sum((F.col("rank") <= k).cast("int")), F.lit(0)) / n).alias(f"top{k}_acc") for k in ks])
    return out.withColumn("perplexity", perplexity(F.col("cross_entropy_loss")))


def accuracy_rollup(df: DataFrame, predicted: str, target: str, kind: str) -> DataFrame:
    """Tested, correct and accuracy by kind of error, and in all (kind null); exact comparison."""
    ok = F.coalesce((F.col(predicted) == F.col(target)).cast("int"), F.lit(0))
    return df.rollup(kind).agg(F.count("*").alias("total_tested"), F.sum(ok).alias("correct"), F.avg(ok).alias("accuracy"))


def accent_restoration(df: DataFrame, predicted: str, target: str, goal: float = 0.95) -> DataFrame:
    """One row over words that bear accents: case aside, how many were restored."""
    rows = df.where(strip_accents(F.col(target)) != F.col(target))
    ok = F.coalesce((F.lower(predicted) == F.lower(target)).cast("int"), F.lit(0))
    out = rows.agg(F.count("*").alias("samples_evaluated"), F.coalesce(F.avg(ok), F.lit(0.0)).alias("accent_accuracy"))
    return out.withColumn("target_met", F.col("accent_accuracy") >= goal)


def validation_loss(df: DataFrame, batch: str, loss: str) -> DataFrame:
    """The mean of batch means, batches whose mean is NaN left out, and its perplexity."""
    means = df.groupBy(batch).agg(F.avg(loss).alias("m")).where("m is not null and not isnan(m)")
    out = means.agg(F.count("*").alias("batches"), F.coalesce(F.avg("m"), F.lit(0.0)).alias("loss"))
    return out.withColumn("perplexity", perplexity(F.col("loss")))


def epoch_loss(df: DataFrame, epoch: str, loss: str) -> DataFrame:
    return df.groupBy(epoch).agg(F.avg(loss).alias("mean_loss"), F.count("*").alias("steps"))


def suggestions(top: DataFrame, id_col: str, show: int = 3) -> DataFrame:
    """The first few of the likeliest tokens as a suggestion bar."""
    return top.where(F.col("rank") <= show).groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("rank", "token"))).alias("s")).select(id_col, F.col("s.token").alias("tokens"))


def autocorrect_inputs(df: DataFrame, text_col: str) -> DataFrame:
    """Rows whose text is exactly one word, with the ``prompt`` that asks for its correction; other rows and null texts drop out."""
    ws = words(F.col(text_col))
    return df.where(F.size(ws) == 1).withColumn("prompt", F.concat(F.lit(X.BAD), F.element_at(ws, 1), F.lit(X.GOOD)))
