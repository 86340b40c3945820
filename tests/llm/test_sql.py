import duckdb
import pytest

from spanfolio.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_is_its_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    found = db.sql(ORACLES[name])
    columns = sorted(found.columns)
    want = sorted(db.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})").fetchall(), key=repr)
    got = QUERIES[name](spark, DATA)
    assert sorted(got.columns) == columns
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == want
