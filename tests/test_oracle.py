"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as contract
from jobmart.plans.queries import ORACLES, QUERIES
from tools.compare import compare, connect


@pytest.fixture(scope="module")
def database(folder):
    return connect(folder)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, database, folder, name):
    state, note = compare(spark, database, folder, name)
    assert state in ("ok", "rows"), note
    assert note != "0 rows"


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["city", "avg_salary", "n_jobs"]
    assert df.count() > 0


def test_only_models_lack_sql():
    missing = set(QUERIES) - set(ORACLES)
    assert missing == {"salary_model_report", "advert_classifier_report"}


def test_entry_point_has_every_query():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
