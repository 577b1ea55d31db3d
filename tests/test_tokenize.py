"""Tokenizer and decoder operators."""

import pytest

from logosmill.operators import model_meta, tokenize

P = pytest.importorskip("public_tokenizers")
MODEL = P.path("piece_bpe_32k.model")


def test_encode_and_vocabulary(spark):
    df = spark.createDataFrame([(1, "Καλημέρα σε όλους"), (2, None), (3, "")], "id bigint, text string")
    got = {r.id: r for r in tokenize.encode(df, "id", "text", MODEL).collect()}
    assert len(got[1].ids) == len(got[1].pieces) > 3 and got[2].ids == got[3].ids == []
    v = tokenize.vocabulary(spark, MODEL)
    assert v.count() == 32_000
    types = {r["token_type"]: r["n"] for r in v.select(model_meta.token_type(v.piece, v.kind).alias("token_type")).groupBy("token_type").count().withColumnRenamed("count", "n").collect()}
    assert types["BYTE"] == 256 and types["UNKNOWN"] == 1 and types["CONTROL"] == 2
    r = tokenize.probe_coverage(spark, MODEL).first()
    assert r.probes == 24 and 0 <= r.single <= 24


def test_greedy_decode(spark):
    df = spark.createDataFrame([(1, [10]), (2, [3]), (3, None)], "id bigint, ids array<int>")
    count_down = lambda rows: [(r[-1] if r else 7) - 1 for r in rows]
    got = {r.id: r.generated for r in tokenize.greedy_decode(df, "id", "ids", count_down).collect()}
    assert got == {1: [9, 8, 7], 2: [], 3: []}
    long = {r.id: r.generated for r in tokenize.greedy_decode(df, "id", "ids", count_down, stops=(-99,)).collect()}
    assert all(len(x) == 8 for x in long.values())
