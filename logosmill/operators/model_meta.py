"""Catalogues of model tensors and vocabularies, and schedules: the relational side of a model."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as X


def tensor_catalogue(spark: SparkSession, layers: int = 9, hidden: int = 512, inner: int = 1376, vocabulary: int = 15008) -> DataFrame:
    """(name, shape, trainable) of a decoder with tied embeddings."""
    rows = [("model.embed_tokens.weight", [vocabulary, hidden]), ("model.norm.weight", [hidden])]
    for i in range(layers):
        p = f"model.layers.{i}."
        rows += [(p + f"self_attn.{x}_proj.weight", [hidden, hidden]) for x in "qkvo"]
        rows += [(p + "mlp.gate_proj.weight", [inner, hidden]), (p + "mlp.up_proj.weight", [inner, hidden]), (p + "mlp.down_proj.weight", [hidden, inner])]
        rows += [(p + "input_layernorm.weight", [hidden]), (p + "post_attention_layernorm.weight", [hidden])]
    return spark.createDataFrame([(n, s, True) for n, s in rows], "name string, shape array<int>, trainable boolean")


def export_names(df: DataFrame) -> DataFrame:
    """``export_name``: the name in the export format; unknown names stay."""
    spark = df.sparkSession
    top = F.broadcast(spark.createDataFrame(list(X.TENSORS.items()), "_n string, _top string"))
    layer = F.broadcast(spark.createDataFrame(list(X.LAYER_TENSORS.items()), "_rest string, _layer string"))
    rows = df.withColumn("_i", F.regexp_extract("name", r"^model\.layers\.([^.]*)\.(.*)$", 1)).withColumn("_r", F.regexp_extract("name", r"^model\.layers\.([^.]*)\.(.*)$", 2))
    rows = rows.join(top, F.col("name") == F.col("_n"), "left").join(layer, F.col("_r") == F.col("_rest"), "left")
    name = F.coalesce("_top", F.when(F.col("_layer").isNotNull(), F.concat(F.lit("blk."), "_i", F.lit("."), "_layer")), "name")
    return rows.withColumn("export_name", name).drop("_i", "_r", "_n", "_top", "_rest", "_layer")


def export_dtype(name: Column, target: str = "f16") -> Column:
    return F.when(name.contains("norm"), "f32").otherwise(target)


def decay_group(name: Column) -> Column:
    return F.when(name.rlike(X.UNDECAYED), "no_decay").otherwise("decay")


def parameter_count(df: DataFrame) -> DataFrame:
    size = F.aggregate("shape", F.lit(1).cast("bigint"), lambda a, x: a * x)
    return df.agg(F.sum(size).alias("total"), F.sum(F.when(F.col("trainable"), size).otherwise(0)).alias("trainable"))


def dtype_histogram(df: DataFrame, target: str = "f16") -> DataFrame:
    return export_names(df).groupBy(export_dtype(F.col("export_name"), target).alias("dtype")).agg(F.count("*").alias("tensors"))


def token_type(piece: Column, kind: Column) -> Column:
    """The type in the export format; ``kind``: unknown, control, unused, byte or normal, first match wins."""
    return (
        F.when(kind == "unknown", "UNKNOWN").when(kind == "control", "CONTROL").when(kind == "unused", "UNUSED").when(kind == "byte", "BYTE")
        .when(piece.isin(X.BAD, X.GOOD, X.END), "USER_DEFINED").otherwise("NORMAL")
    )


def learning_rates(spark: SparkSession, batches: int, epochs: int, accumulation: int = 2, warmup: int = 500, peak: float = 5e-4) -> DataFrame:
    """(step, lr): linear rise, then a cosine down to 0."""
    total = (batches // accumulation) * epochs
    s = F.col("step").cast("double")
    up = s / max(1, warmup)
    down = F.greatest(F.lit(0.0), 0.5 * (1 + F.cos(F.lit(math.pi) * (s - warmup) / max(1, total - warmup))))
    return spark.range(total).select(F.col("id").alias("step")).withColumn("lr", F.lit(peak) * F.when(F.col("step") < warmup, up).otherwise(down))
