"""Training sequences: markers, truncation, padding, label masks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOS, EOS, PAD = 1, 2, 3
BAD_ID, GOOD_ID, END_ID = 4, 5, 6
IGNORED = -100


def toy_ids(words: Column, vocabulary: int = 15008) -> Column:
    """Token numbers of words by hash, for where no trained vocabulary exists."""
    return F.transform(words, lambda w: (F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % (vocabulary - 7) + 7).cast("int"))


def pack_sequences(df: DataFrame, ids_col: str = "ids", masked_col: str | None = None, length: int = 256) -> DataFrame:
    """input_ids, attention_mask and labels of ``length`` each.

    Start and end markers are added, then what is too long is cut at the end
    (the end marker with it). Labels repeat the input; where ``masked_col`` is
    true they are IGNORED up to and with the first GOOD_ID that is left.
    Padding is PAD, IGNORED, 0. Null ids count as none.
    """
    ids = F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>"))
    rest = [c for c in df.columns if c not in (ids_col, masked_col)]
    rows = df.select(*rest, F.slice(F.concat(F.array(F.lit(BOS)), ids, F.array(F.lit(EOS))), 1, length).alias("_i"), (F.col(masked_col) if masked_col else F.lit(False)).alias("_m"))
    rows = rows.select(*rest, "_i", F.size("_i").alias("_n"), F.when(F.col("_m"), F.array_position("_i", F.lit(GOOD_ID))).otherwise(0).alias("_p"))
    fill = lambda v: F.array_repeat(F.lit(v), F.lit(length) - F.col("_n"))
    labels = F.transform("_i", lambda x, i: F.when(i < F.col("_p"), F.lit(IGNORED)).otherwise(x))
    return rows.select(
        *rest, F.concat("_i", fill(PAD)).alias("input_ids"), F.concat(F.array_repeat(F.lit(1), F.col("_n")), fill(0)).alias("attention_mask"), F.concat(labels, fill(IGNORED)).alias("labels")
    )


def training_text(df: DataFrame, samples: DataFrame, id_col: str, line_col: str = "line", correction: float = 0.30, plain: float = 0.35, seed: int = 42) -> DataFrame:
    """What a line is trained on: a correction prompt with probability ``correction`` (if the line allows one), else the line without
    accents with probability ``plain``, else the line. ``is_prompt`` tells which labels to mask."""
    from ..functions.text import draw, strip_accents

    key = F.concat(F.lit(f"{seed}-"), F.col(id_col).cast("string"))
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(line_col).alias("line"), draw(key, "use").alias("_u"), draw(key, "plain").alias("_p"))
    rows = rows.join(samples.select("id", "full_sequence"), "id", "left")
    wanted = F.col("_u") < int(correction * 2**32)
    use = wanted & F.col("full_sequence").isNotNull()
    text = F.when(use, F.col("full_sequence")).when(~wanted & (F.col("_p") < int(plain * 2**32)), strip_accents(F.col("line"))).otherwise(F.col("line"))
    return rows.select("id", text.alias("text"), use.alias("is_prompt"))
