"""Every registered query with a DuckDB twin must return the same rows and types."""

from __future__ import annotations

import pytest

import compare
import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def twin():
    return compare.connection(FOLDER), entry.oracle_sql()


def test_only_fitted_models_lack_a_twin():
    own = set(entry._own_queries())
    assert own - set(entry.oracle_sql()) == {
        "rfm_clusters", "cluster_profiles", "model_metrics", "customer_analytics",
    }


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - set(entry._text_queries())))
def test_query_equals_its_twin(spark, twin, name):
    con, sql = twin
    df = entry.queries()[name](spark, FOLDER)
    assert compare.differences(df.collect(), df.dtypes, con.sql(sql[name])) == []


def test_entry(spark):
    assert entry.entry(spark).count() == 150
