"""The problems' queries on the smallest tables: SQL where there is some, else schema and rows."""

import glob
import os

import duckdb
import pytest

from logosmill.llm import queries as Q

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
FOUND = {
    "p1_found": "id_a bigint, id_b bigint", "p2_found": "rec_id bigint", "p3_found": "id_a bigint, id_b bigint", "p4_found": "rec_id bigint, lang string",
    "p6_found": "rec_id bigint, kind string", "p8_found": "doc_id bigint, item_id bigint", "p9_found": "doc_id bigint",
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


@pytest.mark.parametrize("name", list(Q.queries()))
def test_query(spark, con, name):
    df = Q.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name in FOUND:
        assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == FOUND[name] and len(rows) == len(set(rows))
    if name in ("p1_found", "p3_found"):
        assert all(a < b for a, b in rows)
    assert rows
    if sql := Q.oracle_sql().get(name):
        order = [x[0] for x in con.execute(sql).description]
        want = sorted(repr(tuple(dict(zip(order, r))[c] for c in df.columns)) for r in con.execute(sql).fetchall())
        assert sorted(map(repr, rows)) == want


def test_packed_documents_keep_every_token_and_fit(spark):
    from pyspark.sql import functions as F

    from logosmill.llm import packing

    tokens = packing.document_tokens(Q.load(spark, SF, "documents"), Q.vocabulary_path())
    specs = Q.load(spark, SF, "pack_specs")
    packed = packing.pack(tokens, packing.spec_rows(specs)).cache()
    per = packed.groupBy("spec_id", "id").agg(F.sum("tokens").alias("n"), F.countDistinct("piece").alias("k"), F.count("*").alias("rows"))
    j = per.join(tokens, "id").join(specs, "spec_id")
    assert j.where("n <> tokens or k <> rows or (tokens <= capacity_tokens and k > 1)").count() == 0
    assert per.count() == specs.count() * tokens.where("tokens > 0").count()
    rates = packing.fill_rates(packed, specs, packing.plans(tokens, packing.spec_rows(specs))).collect()
    assert len(rates) == 4 and all(r.fullest <= r.capacity_tokens and r.least_containers <= r.containers <= 1.03 * r.least_containers + 1 for r in rates)


def test_shares_of_cut_documents_are_those_of_the_found(spark):
    cut = {r.doc_id for r in Q.p9_found(spark, SF).collect()}
    source = {r.doc_id: r.source for r in Q.load(spark, SF, "documents").select("doc_id", "source").collect()}
    got = {r.source: (r.documents, r.cut_documents) for r in Q.p9_sources(spark, SF).collect()}
    assert got == {s: (sum(x == s for x in source.values()), sum(source[i] == s for i in cut)) for s in set(source.values())}


def test_records_and_segments_agree(spark):
    records = {r.rec_id: r.lang for r in Q.p4_records(spark, SF).collect()}
    size: dict = {}
    for r in Q.p4_segments(spark, SF).collect():
        assert 0 < r.confidence <= 1 and r.is_passage == (r.words >= 6)
        size.setdefault(r.rec_id, {}).setdefault(r.lang, 0)
        size[r.rec_id][r.lang] += r.words
    assert all(n[records[i]] == max(n.values()) for i, n in size.items() if i in records)
