"""Every registered query against its SQL oracle, over whole tables."""

from __future__ import annotations

import pytest
from oracle_check import compare, oracle_connection

import __spark_entry__ as spark_entry
from hearthlog.schemas import DAILY_COUNT

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert spark_entry.core_queries().keys() == spark_entry.core_oracle_sql().keys()
    assert spark_entry.core_queries().keys() <= spark_entry.queries().keys()


@pytest.mark.parametrize("name", spark_entry.core_queries())
def test_query_equals_oracle(spark, oracle, name):
    same, detail = compare(spark, oracle, SF_DIR, name)
    assert same, detail


def test_entry(spark):
    frame = spark_entry.entry(spark)
    assert frame.columns == DAILY_COUNT.names
    assert frame.count() > 0
