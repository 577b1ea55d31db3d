"""Corpus audit: one pass a statistic, all by partial aggregation."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import lexicon as X
from ..functions.text import BLANKS, greek_letters, has_stress, letters, strip_edges, syllables, words


def totals(df: DataFrame) -> DataFrame:
    n = F.size(words(F.col("line"))).cast("bigint")
    out = df.agg(F.count("*").alias("lines"), F.coalesce(F.sum(n), F.lit(0)).alias("words"), F.coalesce(F.sum(F.length("line").cast("bigint")), F.lit(0)).alias("chars"))
    return out.withColumn("words_per_line", F.round(F.when(F.col("lines") > 0, F.col("words") / F.col("lines")).otherwise(0.0), 6))


def _batch_characters(batches):
    for batch in batches:
        text = "".join(x for x in batch.column(0).to_pylist() if x)
        code, n = np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array([chr(c) for c in code], pa.string()), pa.array(n, pa.int64())], ["char", "n"])


def char_frequency(df: DataFrame) -> DataFrame:
    """How often each character (code point) stands. Counted by Arrow batch, so that a character is a row once a batch."""
    return df.select("line").mapInArrow(_batch_characters, "char string, n bigint").groupBy("char").agg(F.sum("n").alias("n"))


def script_classes(df: DataFrame) -> DataFrame:
    """Characters by class: Greek blocks, Latin (ASCII letters), digits, spaces, and the rest as punctuation."""
    return char_frequency(df).groupBy(script_class(F.col("char")).alias("class")).agg(F.sum("n").alias("n"))


def script_class(char: Column) -> Column:
    return F.when(char.rlike(X.GREEK), "greek").when(char.rlike("[A-Za-z]"), "latin").when(char.rlike(X.DIGIT), "digit").when(char == " ", "space").otherwise("punct")


def corpus_words(df: DataFrame, lower: bool = True) -> DataFrame:
    """(word) stripped at its edges, in lower case, empty ones left out."""
    w = strip_edges(F.col("w"))
    return df.select(F.explode(words(F.col("line"))).alias("w")).select((F.lower(w) if lower else w).alias("word")).where("word <> ''")


def word_frequency(df: DataFrame) -> DataFrame:
    return corpus_words(df).groupBy("word").agg(F.count("*").alias("n"))


def top_words(df: DataFrame, k: int = 20) -> DataFrame:
    """The k most frequent words; ties by the word."""
    return word_frequency(df).orderBy(F.desc("n"), "word").limit(k)


def accent_compliance(df: DataFrame) -> DataFrame:
    """Words of two or more syllables, how many of them bear a stress mark, and the ratio (0 if none)."""
    w = corpus_words(df, lower=False).groupBy("word").agg(F.count("*").alias("n"))
    poly = w.where(syllables(F.col("word")) >= 2)
    out = poly.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("polysyllabic"), F.coalesce(F.sum(F.when(has_stress(F.col("word")), F.col("n")).otherwise(0)), F.lit(0)).alias("accented"))
    return out.withColumn("accent_ratio", F.round(F.when(F.col("polysyllabic") > 0, F.col("accented") / F.col("polysyllabic")).otherwise(0.0), 6))


def unaccented_top(df: DataFrame, k: int = 10) -> DataFrame:
    """The most frequent words of two or more syllables without a stress mark; ties by the word."""
    w = corpus_words(df, lower=False).groupBy("word").agg(F.count("*").alias("n"))
    low = w.where((syllables(F.col("word")) >= 2) & ~has_stress(F.col("word"))).groupBy(F.lower("word").alias("word")).agg(F.sum("n").alias("n"))
    return low.orderBy(F.desc("n"), "word").limit(k)


def shortest(df: DataFrame, order: list[str], k: int = 5) -> DataFrame:
    return df.withColumn("words", F.size(words(F.col("line")))).orderBy("words", *order).limit(k)


def longest(df: DataFrame, order: list[str], k: int = 5) -> DataFrame:
    return df.withColumn("words", F.size(words(F.col("line")))).orderBy(F.desc("words"), *order).limit(k)


def least_greek(df: DataFrame, order: list[str], k: int = 5) -> DataFrame:
    """The lines with the least share of Greek letters, below 1; lines without letters are left out."""
    n = letters(F.col("line"))
    rows = df.withColumn("ratio", F.when(n > 0, greek_letters(F.col("line")) / n))
    return rows.where("ratio < 1").orderBy("ratio", *order).limit(k).withColumn("ratio", F.round("ratio", 6))


def sample_lines(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, by hash of the key and seed."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))).limit(n)


_BLANK = re.compile(f"[{re.escape(BLANKS)}]+")


def _batch_counts(batches):
    for batch in batches:
        lines = [x for x in batch.column(0).to_pylist() if x is not None]
        words: Counter = Counter()
        n = 0
        for x in lines:
            ws = [w for w in _BLANK.split(x) if w]
            n += len(ws)
            words.update(ws)
        text = "".join(lines)
        code, each = np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), return_counts=True)
        kind = ["total"] * 3 + ["char"] * len(code) + ["word"] * len(words)
        key = ["lines", "words", "chars", *(chr(c) for c in code), *words]
        yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(key, pa.string()), pa.array([len(lines), n, len(text), *each.tolist(), *words.values()], pa.int64())], ["kind", "key", "n"])


def counts(df: DataFrame) -> DataFrame:
    """(kind, key, n): totals (lines, words, chars), characters and words as they stand, from one pass over the lines. The whole
    audit but its samples of lines derives from it; it has a row a distinct character or word."""
    return df.select("line").mapInArrow(_batch_counts, "kind string, key string, n bigint").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def report(found: DataFrame, top: int = 20, unaccented: int = 10) -> DataFrame:
    """(section, item, n) of an audit from ``counts`` (written once): totals, scripts, accents, frequent words, frequent words without an accent."""
    of = lambda k: found.where(F.col("kind") == k)
    scripts = of("char").groupBy(script_class(F.col("key")).alias("item")).agg(F.sum("n").alias("n"))
    words = of("word").select(strip_edges(F.col("key")).alias("word"), "n").where("word <> ''")
    low = words.groupBy(F.lower("word").alias("item")).agg(F.sum("n").alias("n"))
    poly = words.where(syllables(F.col("word")) >= 2)
    bare = poly.where(~has_stress(F.col("word")))
    accents = [poly.agg(F.lit("polysyllabic").alias("item"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")), poly.where(has_stress(F.col("word"))).agg(F.lit("accented").alias("item"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))]
    parts = [
        ("totals", of("total").select(F.col("key").alias("item"), "n")), ("totals", low.agg(F.lit("vocabulary").alias("item"), F.count("*").alias("n"))), ("scripts", scripts),
        *(("accents", x) for x in accents), ("frequent", low.orderBy(F.desc("n"), "item").limit(top)),
        ("unaccented", bare.groupBy(F.lower("word").alias("item")).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "item").limit(unaccented)),
    ]
    out = None
    for name, part in parts:
        rows = part.select(F.lit(name).alias("section"), "item", "n")
        out = rows if out is None else out.unionByName(rows)
    return out
