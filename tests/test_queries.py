"""Every registered query against its independent SQL on the smallest benchmark tables."""

from pathlib import Path

import pytest

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from check_oracle import compare, connect
from reportstar.plans.catalog import QUERIES

pytestmark = pytest.mark.skipif(not Path(SMOKE_DIR).is_dir(), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SMOKE_DIR)


def test_every_query_of_the_catalogue_has_its_sql():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["cashier_name", "terminal_type", "income_tnd", "transactions"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        assert compare(spark, duck, name, SMOKE_DIR) == ""
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
