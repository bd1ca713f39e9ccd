"""Every registered query against its SQL oracle on the smallest tables."""

import pytest

import __spark_entry__ as E
from pulsekit.plans.oracle import oracle_sql
from tests.conftest import SF001, SF01
from tests.oracle_compare import compare, connect

SQL = oracle_sql()
#: Queries that need an unbroken series, which the smallest tables do not hold.
LONG_SERIES = {"lag_features", "lag_features_frame", "training_matrix", "zscore_features", "summary_stats",
               "csv_inferred", "persistence_mae", "bpm_predict_check"}


@pytest.fixture(scope="module")
def con():
    return {d: connect(d) for d in (SF001, SF01)}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sf_dir = SF01 if name in LONG_SERIES else SF001
    df = E.queries()[name](spark, sf_dir)
    rows, cols = df.collect(), df.columns
    res = con[sf_dir].execute(SQL[name])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    same_cols, same_n, same_vals, only_a, only_b = compare(cols, rows, ocols, orows)
    assert rows
    assert same_cols, (sorted(cols), sorted(ocols))
    assert same_n, (len(rows), len(orows))
    assert same_vals, (list(only_a.items())[:3], list(only_b.items())[:3])
