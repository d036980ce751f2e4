"""Every registered query against its SQL counterpart, and the rows-only ones for shape."""

import pytest

import __spark_entry__ as entry
from creditmart.plans.catalog import QUERIES as CATALOG
from creditmart.plans.oracles import ORACLES as SQL
from compare import connect, difference

QUERIES, ORACLES = CATALOG, SQL


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_entry_registers_them():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_counterpart_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"files_per_layer", "train_score_lr", "train_score_gbt", "search"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small, con, name):
    assert difference(QUERIES[name](spark, small), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


# The search grows 400 models for minutes; tests/test_jobs.py and test_boosting.py run the operator on a small space.
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"search"}))
def test_rows_only_queries(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
