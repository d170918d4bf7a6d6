import duckdb
import pytest

from tableferry.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", list(ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    cursor = con.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(cursor.fetchall(), key=repr)
