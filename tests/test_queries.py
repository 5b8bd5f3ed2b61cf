"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry
from check_queries import compare
from pixelfold.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    assert compare(spark, con, sf, name) in (None, "no rows")


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_only_queries_without_sql_form_lack_an_oracle():
    missing = set(QUERIES) - set(ORACLES)
    assert missing == {"cubic_resampled", "zonal_percentiles_approximate"}
