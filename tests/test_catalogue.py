"""Every query of the catalogue against its SQL, on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from factloom.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(df: pd.DataFrame) -> list[str]:
    def cell(x):
        if x is None or (not isinstance(x, (list, tuple)) and pd.isna(x)):
            return None
        return round(float(x), 9) if isinstance(x, (int, float)) or hasattr(x, "dtype") else x

    columns = sorted(df.columns)
    return sorted(str([cell(x) for x in row]) for row in df[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert plain(ours) == plain(theirs)


def test_chunks_keep_all_text(spark):
    from factloom.operators.units import chunks, split_text

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = {}
    for r in chunks(docs, 800).orderBy("doc_id", "chunk").collect():
        found.setdefault(r["doc_id"], []).append(r["content"])
    squeeze = lambda s: "".join(s.split())
    for r in docs.collect():
        assert squeeze("".join(found.get(r["doc_id"], []))) == squeeze(r["text"])
    assert split_text("| a | " + "b" * 50 + ". c |\nshort. line!", 20)[0].startswith("| a |")
    assert all(len(c) <= 30 for c in split_text("One two three. " * 40, 30))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
