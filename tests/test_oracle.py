"""Every registered query against its SQL, on the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == ""


@pytest.mark.parametrize("name", ["boost_deep_hourly"])
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_gives_the_golden_metrics(spark):
    rows = {r["split"]: r for r in entry.entry(spark).collect()}
    golden = {
        "train": (347, 2682.375572, 39.424663, -1.199174, 200.980339, 82.538395),
        "val": (56, 2704.532028, 40.224119, -1.207391, 230.829877, 82.437265),
        "test": (56, 2814.102444, 38.858244, -1.179381, 241.509701, 83.154992),
    }
    for split, want in golden.items():
        got = [rows[split][m] for m in ("n_samples", "MSE", "MAE", "R2", "MAPE", "SMAPE")]
        assert got == pytest.approx(want, abs=2e-6)
