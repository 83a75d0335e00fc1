"""Registered queries against their SQL, as the driver compares them."""

import duckdb
import pytest

from jobmart.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, folder, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    expected = con.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    got = QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(expected.fetchall(), key=str)


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
