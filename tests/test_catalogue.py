"""Registered queries against their SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from logosmill.plans import catalogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
SLOW = {"adjacency_candidates"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


def rows(df):
    df = df[sorted(df.columns)]
    cell = lambda x: None if x is None or (isinstance(x, float) and math.isnan(x)) else x.item() if hasattr(x, "item") else x
    return sorted(repr(tuple(map(cell, r))) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n not in SLOW])
def test_query_equals_sql(spark, con, name):
    ours, sql = entry.queries()[name](spark, SF).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(sql.columns)
    assert rows(ours) == rows(sql)


@pytest.mark.parametrize("small", [True, False])
def test_priority_caps(spark, con, small):
    """Small caps bind and agree with the SQL; those of the registered query drop no line of these tables."""
    caps = {"local": None, "conversation": 60, "literature": 20, "encyclopedia": 40} if small else {s: None for s in catalogue.SOURCES}
    got = catalogue._deduped(spark, SF, caps).select("source", "doc_id", "line_no", "hash").toPandas()
    assert rows(got) == rows(con.execute(catalogue._priority_sql(caps)).df())
    if small:
        assert {s: (got["source"] == s).sum() for s, c in caps.items() if c} == {s: c for s, c in caps.items() if c}
    else:
        assert rows(entry.queries()["priority_capped_dedup"](spark, SF).toPandas()) == rows(got)


def test_registered_caps_are_the_references(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    assert catalogue.CAPS == {"local": None, "conversation": 200_000, "literature": 30_000, "encyclopedia": 70_000}
    got = {r["source"]: r["count"] for r in entry.queries()["priority_capped_dedup"](spark, sf).groupBy("source").count().collect()}
    assert got["conversation"] > 1500


def test_sequences_of_every_line(spark, con):
    got = {r["s"]: r["n"] for r in entry.queries()["sequence_pack_lines"](spark, SF).selectExpr("split(id, '-')[0] as s").groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert got == dict(con.execute(f"select source, count(*) from ({catalogue.LINES_SQL}) l group by source").fetchall()) and set(got) == set(catalogue.SOURCES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
