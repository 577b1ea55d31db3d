"""Queries of the nine problems, over whole tables, with production parameters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import components, language, leakage, lookalikes, mixing, neardup, overlap, packing, quality, truncation
from .common import load, records, written
from .oracles import ORACLE

PROSE_TABLES = ("conv_sentences", "wiki_articles")
SMALL_SHARD = 400_000
SENTENCE_TABLES = ("conv_sentences", "lit_sentences")


def common_words(spark: SparkSession, sf_dir: str) -> list[tuple[str, str]]:
    """The table of common words (fixed, under 200 rows)."""
    return [(r.lang, r.word) for r in load(spark, sf_dir, "common_words").select("lang", "word").orderBy("lang", "rank_no").collect()]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = overlap.overlap_pairs(*overlap.split_overlaps(records(spark, sf_dir)))
    return pairs.select(F.least("train_id", "eval_id").alias("id_a"), F.greatest("train_id", "eval_id").alias("id_b")).distinct()


def p1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with small shards, so that records are routed to several indexes at any but the smallest scale."""
    pairs = overlap.overlap_pairs(*overlap.split_overlaps(records(spark, sf_dir), shard_words=SMALL_SHARD))
    return pairs.select(F.least("train_id", "eval_id").alias("id_a"), F.greatest("train_id", "eval_id").alias("id_b")).distinct()


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per evaluation split and source table of the evaluation record: overlapping pairs, evaluation records concerned, and how much maximal matches cover."""
    rows = records(spark, sf_dir)
    pairs = overlap.overlap_pairs(*overlap.split_overlaps(rows, with_spans=True)).select("train_id", "eval_id", "similarity", "covered", "spans").distinct()
    where = rows.where("split_name in ('val', 'test')").select(F.col("rec_id").alias("eval_id"), "split_name", "source_name").distinct()
    return pairs.join(where, "eval_id").groupBy("split_name", "source_name").agg(
        F.count("*").alias("pairs"), F.countDistinct("eval_id").alias("eval_records"), F.avg("similarity").alias("mean_similarity"), F.sum("covered").alias("covered_words"), F.sum("spans").alias("spans")
    )


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalikes.normalize_lookalikes(records(spark, sf_dir, PROSE_TABLES), changed_only=True).distinct()


def p2_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's text in the consistent form, and whether that changed it."""
    return lookalikes.normalize_lookalikes(records(spark, sf_dir, PROSE_TABLES)).dropDuplicates(["rec_id"])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.alike_pairs(*neardup.alike_classes(records(spark, sf_dir, SENTENCE_TABLES))).distinct()


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group id (the least record id of the group) and the number of links between texts for every record with a non-empty text; records alike to none are groups of their own."""
    rows = records(spark, sf_dir, SENTENCE_TABLES)
    links, group = neardup.alike_classes(rows)
    links = written(links, "p3-links")
    cc = components.connected_components(links)
    ends = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").count()
    own = group.join(cc.withColumnRenamed("id", "rep"), "rep", "left").join(ends, "rep", "left").select(F.col("id").alias("rec_id"), F.coalesce("component", "rep").alias("group_id"), F.coalesce("count", F.lit(0)).alias("links"))
    every = rows.where("text <> ''").select("rec_id").distinct()
    return every.join(own, "rec_id", "left").select("rec_id", F.coalesce("group_id", "rec_id").alias("group_id"), F.coalesce("links", F.lit(0)).cast("bigint").alias("links"))


def _language(spark: SparkSession, sf_dir: str, output: str) -> DataFrame:
    common = common_words(spark, sf_dir)
    rows = records(spark, sf_dir, PROSE_TABLES)
    return language.label_languages(rows, language.fit_language_model(rows, common), common, output=output)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _language(spark, sf_dir, "found").distinct()


def p4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _language(spark, sf_dir, "documents").dropDuplicates(["rec_id"])


def p4_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _language(spark, sf_dir, "segments").dropDuplicates(["rec_id", "segment"])


def p5_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of each mix and source."""
    shares = mixing.mix_sources(records(spark, sf_dir), load(spark, sf_dir, "mix_targets"))[1]
    return shares.withColumn("budget", F.round("budget", 3)).withColumns({c: F.round(c, 6) for c in ("actual_share", "share_of_target_size")})


def p5_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each record is used in each mix."""
    return mixing.mix_sources(records(spark, sf_dir), load(spark, sf_dir, "mix_targets"))[0]


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality.text_quality(records(spark, sf_dir, PROSE_TABLES), common_words(spark, sf_dir))
    return stats.where("kind <> 'prose'").select("rec_id", "kind").distinct()


def p6_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.text_quality(records(spark, sf_dir, PROSE_TABLES), common_words(spark, sf_dir)).dropDuplicates(["rec_id"])


def p6_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics of p6_stats that SQL can follow."""
    stats = quality.text_quality(records(spark, sf_dir, PROSE_TABLES), common_words(spark, sf_dir)).dropDuplicates(["rec_id"])
    return stats.select("rec_id", "words", F.round("mean_word_length", 6).alias("mean_word_length"), "lines", F.round("stop_line_share", 6).alias("stop_line_share"))


def vocabulary_path() -> str:
    """The vocabulary file of p7: LOGOSMILL_VOCABULARY, or the container's copy of a public one."""
    return os.environ.get("LOGOSMILL_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")


def _tokens(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return packing.document_tokens(load(spark, sf_dir, "documents"), vocabulary_path()), load(spark, sf_dir, "pack_specs")


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of each document or piece, for every row of pack_specs."""
    tokens, specs = _tokens(spark, sf_dir)
    return packing.pack(tokens, packing.spec_rows(specs)).withColumnRenamed("id", "doc_id")


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, fill rate and lower bound of every row of pack_specs."""
    tokens, specs = _tokens(spark, sf_dir)
    rows = packing.spec_rows(specs)
    return packing.fill_rates(packing.pack(tokens, rows), specs, packing.plans(tokens, rows))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_items")).select("doc_id", "item_id").distinct()


def p8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per suite and source: items that leaked, documents concerned, and documents that hold an item wholly."""
    hits = leakage.leaked_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_items")).distinct()
    docs = load(spark, sf_dir, "documents").select("doc_id", "source")
    items = load(spark, sf_dir, "eval_items").select("item_id", "suite").distinct()
    return (
        hits.join(docs, "doc_id").join(items, "item_id").groupBy("suite", "source")
        .agg(F.countDistinct("item_id").alias("items"), F.countDistinct("doc_id").alias("documents"), F.countDistinct(F.when(F.expr("windows = item_windows"), F.col("doc_id"))).alias("whole_documents"))
    )


def _truncation(spark: SparkSession, sf_dir: str, cut_only: bool) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    model, limits = truncation.fit_truncation(docs, [w for _, w in common_words(spark, sf_dir)])
    return truncation.score_truncation(docs, model, limits, cut_only=cut_only)


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _truncation(spark, sf_dir, True).distinct()


def p9_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, cut documents and their share per source."""
    s = _truncation(spark, sf_dir, False).dropDuplicates(["doc_id"])
    return s.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.col("cut").cast("bigint")).alias("cut_documents"), F.avg(F.col("cut").cast("double")).alias("cut_share"))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_shards, p1_report, p2_found, p2_text, p3_found, p3_groups, p4_found, p4_records, p4_segments, p5_usage, p5_shares, p6_found, p6_ratios, p6_stats, p7_containers, p7_fill, p8_found, p8_report, p9_found, p9_sources)
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
