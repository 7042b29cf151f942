"""Every corpus query that has SQL gives the same rows in both engines."""

from pathlib import Path

import duckdb
import pytest

from corpusloom.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for path in Path(small).glob("*.parquet"):
        connection.sql(f"create view {path.stem} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    columns = sorted(df.columns)
    rows = sorted(tuple(map(str, r)) for r in df.select(*columns).collect())
    sql = duck.sql(f"select {', '.join(columns)} from ({ORACLE[name]})")
    assert sorted(sql.columns) == columns and rows == sorted(tuple(map(str, r)) for r in sql.fetchall())
