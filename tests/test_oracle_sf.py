"""Every registered query against its SQL oracle on the driver's sf0.001 tables."""

import pytest
from conftest import SF_SMALL
from oracle_check import compare, duck

import __spark_entry__ as entry


from txrisk.plans.oracle import ORACLE_SQL as OWN  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, SF_SMALL, con)
    assert res["ok"], res


def test_every_query_has_an_oracle():
    from txrisk.plans.registry import QUERIES

    assert not set(QUERIES) - set(entry.oracle_sql())


def test_preview_returns_one_row(spark):
    from txrisk.operators.quality import preview
    from txrisk.sources.fixtures import tx_lines

    assert preview(tx_lines(spark, SF_SMALL)).count() == 1
