"""The operators' queries against their SQL."""

import duckdb
import pytest

from factloom.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    theirs = con.execute(ORACLE_SQL[name]).df()
    ours = QUERIES[name](spark, SF).toPandas()
    columns = sorted(theirs.columns)
    assert sorted(ours.columns) == columns
    assert sorted(map(tuple, ours[columns].values.tolist())) == sorted(map(tuple, theirs[columns].values.tolist()))


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
