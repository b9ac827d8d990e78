"""Every named query against its DuckDB oracle on the smallest test tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from basketspark.plans.catalog import QUERIES, day_part_baskets
from tools.compare import compare

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, name):
    result = compare(spark, sf_small, [name])[name]
    assert result.startswith("OK"), result


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["MASTER_ID", "RECORD_ID"]
    assert df.count() > 0


def test_day_part_baskets_pass_the_session_cap(spark):
    baskets = day_part_baskets(spark, "/root/testdata/sf0.01").groupBy("basket_key").agg(F.countDistinct("coupon_key").alias("n"))
    assert baskets.agg(F.max("n")).first()[0] > 30
