"""Every registered query against its DuckDB oracle on the smallest test tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from strata.plans.queries import QUERIES
from tests.oracle_harness import compare, duck_connection

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck_connection(sf_dir)


def test_every_key_has_an_oracle():
    missing = [k for k in KEYS if k not in oracle_sql()]
    assert missing == []


def test_registry_covers_survey_index():
    assert len(KEYS) == 84
    assert set(KEYS) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["year", "month", "monthly_revenue"]
    assert df.count() > 0


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, sf_dir, key):
    problems = compare(spark, con, key, queries()[key], oracle_sql()[key], sf_dir)
    assert problems == []


TIME_KEYS = ["silver_orders", "kpi_delivery_unrounded", "chart_monthly_orders", "latest_review_per_order"]


@pytest.mark.parametrize("key", TIME_KEYS)
def test_results_do_not_depend_on_session_time_zone(spark, con, sf_dir, key):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert compare(spark, con, key, queries()[key], oracle_sql()[key], sf_dir) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
