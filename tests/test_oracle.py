"""Every registered query against its SQL twin, whole tables, smallest scale."""

import os

import oracle
import pytest

from __spark_entry__ import entry
from retailtide.catalog import oracle_sql, queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_matches_sql(name, spark, con):
    oracle.compare(queries()[name], oracle_sql()[name], spark, con, SF_DIR)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == [
        "ds",
        "window_start",
        "window_end",
        "win_gmv",
        "win_gmv_ids",
        "top5_product_ids",
    ]
    assert frame.count() > 0
