"""Registered queries over files: tables written by the writers into the shared folder and read back by the readers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as X
from ..functions import text as T
from ..operators import clean, corrupt, dedup, logs, metrics, model_meta, sequence, split, tokenize, vocab
from ..sources import readers, writers
from .base import CORPUS_SQL, LINES_SQL, ORDER, SOURCE_SQL, all_lines, corpus, plain_sql, q, source_lines, table, words_sql
from .catalogue import _AUGMENTED, _IDS, _LOG, _MANIFEST, _PROGRESS, _SPLIT, _TYPOS, _spaced, _typos, query
from .shared import shared_dir


def place(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def piece_model() -> str:
    """The SentencePiece model of the queries: LOGOSMILL_PIECES, or the container's copy of a public one."""
    return os.environ.get("LOGOSMILL_PIECES", "/opt/tokenizers/piece_bpe_32k.model")


@query(f"select line, count(*) as n from ({SOURCE_SQL['local']}) l group by line")
def read_text_files(spark, sf_dir):
    """Local texts as files of lines, read back."""
    path = place(spark, "texts")
    table(spark, sf_dir, "documents").where("source = 'local_txt' and text is not null").select("text").write.text(path)
    return readers.read_lines(spark, path).groupBy("line").agg(F.count("*").alias("n"))


@query(f"select line, count(*) as n from ({SOURCE_SQL['encyclopedia']}) l group by line")
def read_json_files(spark, sf_dir):
    """Articles as JSON files between malformed records and records without text."""
    path = place(spark, "records")
    d = table(spark, sf_dir, "wiki_articles").select("rec_id", "text").distinct().select(F.to_json(F.struct("text")).alias("value"))
    bad = spark.createDataFrame([(x,) for x in ('{"text": "', "no record", '{"other": 1}', "", '{"text": null}')], "value string")
    d.unionByName(bad).write.option("compression", "none").text(path)
    return readers.read_json_lines(spark, path, "*.txt").groupBy("line").agg(F.count("*").alias("n"))


_SAMPLE = "select distinct sample_id, context, corrupted_word, target_word, error_type, full_sequence from typo_samples"


@query(f"select context, corrupted_word, target_word, error_type, full_sequence from ({_SAMPLE}) s order by sample_id, context, corrupted_word, target_word, error_type, full_sequence limit 500")
def read_samples_first(spark, sf_dir):
    """The first 500 samples in the order of the files."""
    path = place(spark, "samples")
    order = ["sample_id", "context", "corrupted_word", "target_word", "error_type", "full_sequence"]
    d = table(spark, sf_dir, "typo_samples").select(*order).distinct()
    writers.write_samples(d.repartitionByRange(*order).sortWithinPartitions(*order).select(*order[1:]), path)
    return readers.read_samples(spark, path, 500)


@query(f"select step, loss, lr, count(*) as n from ({_PROGRESS}) p group by step, loss, lr")
def read_log_files(spark, sf_dir):
    """Training logs as files, each read whole."""
    path = place(spark, "log")
    d = table(spark, sf_dir, "training_log").select("log_id", "run_key", "text").distinct().where("text is not null")
    d.repartition("run_key").sortWithinPartitions("log_id").select(F.concat("text", F.lit("\n")).alias("value")).write.text(path)
    return logs.progress_points(readers.read_log(spark, path), ["file"]).groupBy("step", "loss", "lr").agg(F.count("*").alias("n"))


@query("select * from (values ('catalogue', 1, 'small', 'Q6', 22::BIGINT, 2), ('catalogue', 1, 'large', 'Q8', 27::BIGINT, 1)) as m(catalogue, version, id, quantization, filesize_bytes, features)")
def read_manifest_file(spark, sf_dir):
    path = place(spark, "manifest")
    spark.createDataFrame([(_MANIFEST.replace("}, {", "},\n {"),)], "value string").coalesce(1).write.text(path)
    m = readers.read_manifest(spark, path)
    return m.select("catalogue", F.col("version").cast("int").alias("version"), "id", "quantization", "filesize_bytes", F.size("features").alias("features"))


def _split_lines(spark, sf_dir) -> DataFrame:
    return split.split_lines(dedup.keep_first(clean.cleaned(all_lines(spark, sf_dir, once=False)), ORDER).select("hash", "line"))


@query(_SPLIT + "select split, line from s")
def split_files(spark, sf_dir):
    """The splits written as text and read back."""
    path = place(spark, "splits")
    writers.write_splits(_split_lines(spark, sf_dir), path)
    return spark.read.text(path).select("split", F.col("value").alias("line"))


@query(
    _SPLIT + "select count(*) as total_lines, sum(cast(split = 'train' as bigint))::BIGINT as train_lines, sum(cast(split = 'val' as bigint))::BIGINT as val_lines, sum(cast(split = 'test' as bigint))::BIGINT as test_lines, "
    "3::BIGINT as min_words_per_line, 40::BIGINT as max_words_per_line, 0.85::DOUBLE as min_greek_ratio from s"
)
def stats_file(spark, sf_dir):
    """The statistics of the splits as a file."""
    path = place(spark, "stats")
    writers.write_stats(split.dataset_stats(_split_lines(spark, sf_dir).drop("line")), path)
    d = spark.read.json(path)
    return d.select("total_lines", "train_lines", "val_lines", "test_lines", "min_words_per_line", "max_words_per_line", "min_greek_ratio")


@query(f"select context, corrupted_word, target_word, error_type, full_sequence, count(*) as n from ({_TYPOS}) t group by all")
def sample_files(spark, sf_dir):
    """Correction samples as JSON files, read back."""
    path = place(spark, "drawn")
    writers.write_samples(_typos(spark, sf_dir).drop("id"), path)
    d = readers.read_samples(spark, path, None)
    return d.groupBy(*d.columns).agg(F.count("*").alias("n"))


@query(
    "with w as (select concat(word, ' ') as line, least(50, greatest(6, cast(floor(pow(n, 0.52)) as bigint))) as n from (" + _AUGMENTED + ") a order by a.n desc, word limit 14000), "
    f"s as (select {_spaced('line')} as line from ({CORPUS_SQL}) c) "
    f"select line, sum(n)::BIGINT as n from (select concat(w, ' ') as line, 120 as n from (select unnest([{', '.join(q(w) for w in X.PRIORITY_WORDS)}]) as w) p union all select * from w "
    f"union all select line, 1 from s where line <> '' union all select {plain_sql('line')}, 1 from s where line <> '') u group by line"
)
def seed_corpus_file(spark, sf_dir):
    """The corpus that seeds a vocabulary, as a file, its lines counted."""
    path = place(spark, "seeds")
    writers.write_seed_corpus(vocab.seed_corpus(corpus(spark, sf_dir)), path)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


_FALLBACK = f"select i as seq, list_extract([{', '.join(q(s) for s in X.FALLBACK)}], cast(concat('0x', substr(md5(concat('42|', cast(i as varchar))), 1, 8))::BIGINT % {len(X.FALLBACK)} as integer) + 1) as line"


@query(_FALLBACK + " from (select unnest(range(10000)) as i) r")
def fallback_corpus(spark, sf_dir):
    """What stands in for the corpus where no source gives a line."""
    return readers.or_fallback(clean.cleaned(all_lines(spark, sf_dir).limit(0)), X.FALLBACK, 10_000).select("seq", "line")


@query(f"select source, doc_id, line_no, concat('<XBU>', ws[1], '<XBC>') as prompt from (select *, {words_sql('line')} as ws from ({LINES_SQL}) l) m where len(ws) = 1")
def autocorrect_inputs(spark, sf_dir):
    """Lines of exactly one word as prompts for correction."""
    return metrics.autocorrect_inputs(all_lines(spark, sf_dir), "line").select("source", "doc_id", "line_no", "prompt")


# Pieces of a public vocabulary, which SQL cannot count


@query()
def vocabulary_types(spark, sf_dir):
    """Pieces of the vocabulary by type."""
    v = tokenize.vocabulary(spark, piece_model())
    return v.groupBy(model_meta.token_type(F.col("piece"), F.col("kind")).alias("token_type")).agg(F.count("*").alias("pieces"))


@query()
def vocabulary_composition(spark, sf_dir):
    """Whole words, suffixes and prefixes among the pieces of the vocabulary, against the words of the corpus."""
    return vocab.piece_composition(tokenize.vocabulary(spark, piece_model()).select("piece"), corpus(spark, sf_dir, once=False))


@query()
def probe_words(spark, sf_dir):
    """How many of the probe words are one piece."""
    return tokenize.probe_coverage(spark, piece_model())


@query()
def sequence_pack_pieces(spark, sf_dir):
    """Training sequences of every line, in pieces of the vocabulary."""
    rows = all_lines(spark, sf_dir).select(F.concat_ws("-", "source", F.col("doc_id").cast("string"), F.col("line_no").cast("string")).alias("id"), "line")
    return sequence.pack_sequences(tokenize.encode(rows, "id", "line", piece_model()).select("id", "ids"))


# The likeliest next word as a decoder: ids are hashes of words, so that SQL can follow

_LIT = f"select cast(doc_id as varchar) as id, list_concat({_IDS.format(w=words_sql('line'))}, [2]) as x from ({SOURCE_SQL['literature']}) l"
_NEXT = f"select t, arg_max(u, n * 100000 - u) as u from (select t, u, count(*) as n from (select unnest(x[:-2]) as t, unnest(x[2:]) as u from ({_LIT}) a) b group by t, u) c group by t"


@query(
    f"with recursive nxt as ({_NEXT}), g as (select id, x[-2] as t, 0 as k from ({_LIT}) a union all select id, coalesce(u, 2), k + 1 from g left join nxt on g.t = nxt.t where k < 8 and (k = 0 or g.t not in (2, 6))) "
    "select id, coalesce(string_agg(cast(t as varchar), ' ' order by k) filter (k > 0 and t not in (2, 6)), '') as generated from g group by id"
)
def greedy_decoding(spark, sf_dir):
    """Up to eight words after each line of literature, each the one that follows most often."""
    rows = source_lines(spark, sf_dir, "literature").select(F.col("doc_id").cast("string").alias("id"), sequence.toy_ids(T.words(F.col("line"))).alias("ids"))
    pairs = rows.select(F.explode(F.expr("arrays_zip(ids, concat(slice(ids, 2, size(ids)), array(2)))")).alias("p")).select(F.col("p.ids").alias("t"), F.col("p.1").alias("u"))
    best = pairs.groupBy("t", "u").count().groupBy("t").agg(F.max_by("u", F.struct("count", -F.col("u"))).alias("u"))
    after = {r.t: r.u for r in best.collect()}  # as many as the vocabulary has ids at most
    made = tokenize.greedy_decode(rows, "id", "ids", lambda seqs: [after.get(s[-1], 2) if s else 2 for s in seqs])
    return made.select("id", F.array_join(F.transform("generated", lambda x: x.cast("string")), " ").alias("generated"))
