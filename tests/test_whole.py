"""Queries over whole tables against their SQL, on tables larger than the parts that other queries read."""

import duckdb
import pytest
from test_catalogue import TABLES, plain

from factloom.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def check(spark, duck, name):
    assert plain(QUERIES[name](spark, SF).toPandas()) == plain(duck.execute(ORACLE_SQL[name]).df())


def test_candidate_pairs(spark, duck):
    check(spark, duck, "candidate_pairs")
    assert QUERIES["candidate_pairs"](spark, SF).select("a").distinct().count() > 399


@pytest.mark.parametrize("name", ["graph_build", "relation_types"])
def test_graph_and_types(spark, duck, name):
    check(spark, duck, name)


@pytest.mark.parametrize(("name", "starts"), [("beam_paths", 6), ("event_components", 5)])
def test_paths_and_events(spark, duck, name, starts):
    check(spark, duck, name)
    assert QUERIES[name](spark, SF).select("qid").distinct().count() > starts


def test_links_hold_every_label(spark):
    from factloom.catalogue import linked

    texts = ["the Acme, and more", "Foo  Bar\nBaz", "foobarbaz quux", "plain labels", "", None, "STRASSE Straße x", "a long entity name that goes on, here"]
    names = ["Acme", "foo bar", "foob arbaz", "plain label", "Label", "", None, "straße", "Long entity name that goes on", "absent"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "qid long, label string")
    squeeze = lambda s: "".join(s.lower().replace("ß", "ss").split())
    want = sorted((q, d, 12 + len(squeeze(n))) for q, n in enumerate(names) for d, t in enumerate(texts) if n is not None and t is not None and squeeze(n) in squeeze(t))
    assert sorted((r["qid"], r["doc_id"], r["score"]) for r in linked(docs, bench).collect()) == want
