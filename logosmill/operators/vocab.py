"""Vocabulary statistics and the corpus that seeds a vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as X
from ..functions.text import space_punctuation, strip_accents
from .audit import corpus_words


def seed_words(df: DataFrame) -> DataFrame:
    """Words with their case, counted; words with a digit are left out."""
    return corpus_words(df, lower=False).where(~F.col("word").rlike(X.DIGIT)).groupBy("word").agg(F.count("*").alias("n"))


def augmented(counts: DataFrame) -> DataFrame:
    """Each word that bears accents adds its count to its plain form, once."""
    plain = strip_accents(F.col("word"))
    both = counts.select(F.explode(F.when(plain != F.col("word"), F.array(F.col("word"), plain)).otherwise(F.array("word"))).alias("word"), "n")
    return both.groupBy("word").agg(F.sum("n").alias("n"))



def seed_corpus(df: DataFrame, top: int = 14000, priority_times: int = 120) -> DataFrame:
    """(kind, line): priority words, frequent words by weight (each with a space after it), then every line with spaced punctuation, as it is and plain."""
    spark = df.sparkSession
    first = spark.createDataFrame([(w,) for w in X.PRIORITY_WORDS], "word string").select(F.lit("priority").alias("kind"), F.explode(F.array_repeat(F.concat("word", F.lit(" ")), priority_times)).alias("line"))
    ranked = augmented(seed_words(df)).orderBy(F.desc("n"), "word").limit(top)
    second = ranked.select(F.lit("word").alias("kind"), F.explode(F.expr("array_repeat(concat(word, ' '), least(50, greatest(6, cast(floor(pow(cast(n as double), 0.52D)) as int))))")).alias("line"))
    spaced = df.select(space_punctuation(F.col("line")).alias("s")).where("s <> ''")
    third = spaced.select(F.lit("line").alias("kind"), F.explode(F.array(F.col("s"), strip_accents(F.col("s")))).alias("line"))
    return first.unionByName(second).unionByName(third)


def piece_composition(pieces: DataFrame, df: DataFrame | None, mark: str = "▁") -> DataFrame:
    """Pieces by class: special, whole (a corpus word or its plain form, with the end mark), suffix, prefix; shares in percent."""
    raw = F.regexp_replace("piece", f"{mark}+$", "")
    p = pieces.select("piece", raw.alias("raw"), F.col("piece").startswith("<").alias("special"), F.col("piece").endswith(mark).alias("ends"))
    if df is not None:
        w = corpus_words(df, lower=False)
        known = w.select(F.explode(F.array(F.col("word"), strip_accents(F.col("word")))).alias("raw")).join(pieces.select(raw.alias("raw")).distinct(), "raw", "left_semi").distinct().withColumn("known", F.lit(True))
        p = p.join(known, "raw", "left")
    else:
        p = p.withColumn("known", F.lit(True))
    kind = F.when(F.col("special"), "special").when(F.col("ends") & F.col("known").isNotNull(), "whole").when(F.col("ends"), "suffix").otherwise("prefix")
    out = p.groupBy(kind.alias("class")).agg(F.count("*").alias("n"))
    total = p.agg(F.count("*").alias("total"))
    return out.join(F.broadcast(total)).select("class", "n", F.round(100 * F.col("n") / F.col("total"), 4).alias("percent"))
