"""Every query against its SQL statement, over whole tables."""

import os

import pytest
from compare import differences, open_tables

from ledgerloom.checks.oracle import SQL
from ledgerloom.checks.presentation import comparable
from ledgerloom.plans.catalog import QUERIES
from ledgerloom.plans.portfolio import Portfolio
from ledgerloom.streaming.catalog import STREAM_QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
ALL = {**QUERIES, **STREAM_QUERIES}
FITTED = {"trained_reading"}  # hold a fitted model; tested in test_reading.py


@pytest.fixture(scope="module")
def portfolio(spark):
    return Portfolio(spark, SF_DIR)


@pytest.fixture(scope="module")
def tables():
    return open_tables(SF_DIR)


def test_every_query_has_its_statement():
    assert set(ALL) == set(SQL) | FITTED


@pytest.mark.parametrize("name", [n for n in ALL if n not in FITTED])
def test_query_equals_sql(name, portfolio, tables):
    assert differences(comparable(ALL[name](portfolio)), tables, SQL[name]) is None
