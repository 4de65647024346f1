"""Every job with a SQL twin gives the same rows on whole tables."""

import pytest

from __spark_entry__ import entry
from paperflow.plans import jobs, sql_twins

from .sql_twin import compare, sql_session

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return sql_session(FOLDER)


@pytest.mark.parametrize("name", sorted(jobs()))
def test_twin(spark, con, name):
    assert name in sql_twins(), "every job here has a SQL twin"
    assert compare(jobs()[name](spark, FOLDER), con, sql_twins()[name]) is None


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.columns == ["bucket_rank", "bucket", "badge", "n"]
    assert df.count() > 0
