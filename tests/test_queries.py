"""Every registered query outside the corpus package, against its oracle on the smallest tables."""

from __future__ import annotations

import pytest
from oracle import assert_equal

from quarry.plans import catalog

ORACLES, QUERIES = catalog.oracle_sql(), catalog.queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, small_tables, name):
    assert_equal(QUERIES[name](spark, small_tables), ORACLES[name], small_tables)


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys() - {"ml_score", "ml_cv"}))
def test_runs(spark, small_tables, name):
    QUERIES[name](spark, small_tables).count()


def test_flagship(spark, small_tables):
    assert catalog.flagship(spark, small_tables).count() > 0


def test_entry_names_agree():
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
