from __future__ import annotations

import pytest
from gridloom.plans import catalogue
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_matches_sql(spark, sf, name):
    compare(spark, sf, catalogue.queries()[name], catalogue.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_runs(spark, sf, name):
    assert catalogue.queries()[name](spark, sf).count() > 0
