"""Every query that has SQL gives the same rows in both engines."""

from pathlib import Path

import duckdb
import pytest

from corpusloom.plans import catalog, filequeries  # noqa: F401


def shown(v):
    return "~" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for path in Path(small).glob("*.parquet"):
        connection.sql(f"create view {path.stem} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_same_rows(spark, small, duck, name):
    df = catalog.QUERIES[name](spark, small)
    columns = sorted(df.columns)
    rows = sorted(tuple(map(shown, r)) for r in df.select(*columns).collect())
    sql = duck.sql(f"select {', '.join(columns)} from ({catalog.ORACLE[name]})")
    assert sorted(sql.columns) == columns
    assert rows == sorted(tuple(map(shown, r)) for r in sql.fetchall())


def test_every_query_has_sql_and_rows(spark, small):
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    for name in ("clean_wiki_text", "entry_completion_gate", "cpt_build", "qa_generate", "wiki_dump", "upload_staging"):
        assert catalog.QUERIES[name](spark, small).count() > 0
