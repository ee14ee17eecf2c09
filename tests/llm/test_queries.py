"""The registered queries against their SQL on the small tables."""

import os

import duckdb
import pytest

from costalloc.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL


def plain(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for file in os.listdir(SMALL):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{file}'")
    result = QUERIES[name](spark, SMALL)
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert plain(map(tuple, result.collect()), result.columns) == plain(cursor.fetchall(), columns)
