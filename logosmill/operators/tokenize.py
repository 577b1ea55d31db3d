"""Trained tokenizers and decoders applied to tables: loaded once a worker, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lexicon as X

_LOADED: dict = {}


def _model(path: str):
    """The SentencePiece model of a file, or of the serialized bytes in it, once a process."""
    if path not in _LOADED:
        import sentencepiece

        _LOADED[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _LOADED[path]


def encode(df: DataFrame, id_col: str, text_col: str, model_path: str) -> DataFrame:
    """(id, ids, pieces) of each text; null texts give empty arrays."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        sp = _model(model_path)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            ids = sp.encode(texts, num_threads=1) if texts else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array([[sp.id_to_piece(i) for i in x] for x in ids], pa.list_(pa.string()))], ["id", "ids", "pieces"])

    return df.select(id_col, text_col).mapInArrow(run, f"id {kind}, ids array<int>, pieces array<string>").withColumnRenamed("id", id_col)


def vocabulary(spark: SparkSession, model_path: str) -> DataFrame:
    """(id, piece, score, kind) of a model; kind: unknown, control, unused, byte or normal."""
    sp = _model(model_path)
    kind = lambda i: "unknown" if sp.is_unknown(i) else "control" if sp.is_control(i) else "unused" if sp.is_unused(i) else "byte" if sp.is_byte(i) else "normal"
    return spark.createDataFrame([(i, sp.id_to_piece(i), float(sp.get_score(i)), kind(i)) for i in range(sp.get_piece_size())], "id int, piece string, score double, kind string")


def probe_coverage(spark: SparkSession, model_path: str, mark: str = "▁", words: list[str] = X.PROBE_WORDS) -> DataFrame:
    """One row: probe words, and how many are a single piece with the mark of a word's edge."""
    rows = encode(spark.createDataFrame([(w, w + " ") for w in words], "word string, text string"), "word", "text", model_path)
    single = (F.size("pieces") == 1) & F.element_at("pieces", 1).contains(mark)
    return rows.agg(F.count("*").alias("probes"), F.sum(F.coalesce(single, F.lit(False)).cast("bigint")).alias("single"))


def greedy_decode(df: DataFrame, id_col: str, ids_col: str, scorer: Callable[[list[list[int]]], list[int]], stops: tuple[int, ...] = (2, 6), most: int = 8) -> DataFrame:
    """(id, generated): up to ``most`` tokens, each the scorer's best next token for the ids so far; a stop token ends a row and is left out.

    ``scorer`` takes the rows of a batch that still run and returns a token for each.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            seqs = [list(x or []) for x in batch.column(1).to_pylist()]
            out: list[list[int]] = [[] for _ in seqs]
            live = list(range(len(seqs)))
            for _ in range(most):
                if not live:
                    break
                nxt = scorer([seqs[i] + out[i] for i in live])
                going = []
                for i, t in zip(live, nxt):
                    if t not in stops:
                        out[i].append(int(t))
                        going.append(i)
                live = going
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int32()))], ["id", "generated"])

    return df.select(id_col, F.col(ids_col).cast("array<int>")).mapInArrow(run, f"id {kind}, generated array<int>").withColumnRenamed("id", id_col)
