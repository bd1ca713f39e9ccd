"""Driver contract and golden counts of the stand-ins (FIXTURES §3)."""

import __spark_entry__ as E
from tests.conftest import SF01


def test_registry_has_an_oracle_for_every_sql_expressible_query():
    from pulsekit.plans.oracle import oracle_sql
    from pulsekit.plans.queries import queries
    assert set(E.oracle_sql()) <= set(E.queries())
    qs, sql = queries(), oracle_sql()
    assert set(qs) <= set(E.queries())
    assert set(qs) - set(sql) == {"bpm_predict", "model_errors"}  # predictions and errors of trained models


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "HOUR", "min_value", "avg_value", "max_value", "sport"]
    assert df.count() > 0


def test_golden_label_counts(spark):
    q = E.queries()
    assert q["label_fanout"](spark, SF01).count() == 10035
    assert q["label_fanout_carry"](spark, SF01).count() == 10034
    lw = q["label_last_wins"](spark, SF01)
    assert lw.count() == 10000
    by = {r.sport: r.n_samples for r in q["labels_per_sport"](spark, SF01).collect()}
    assert by == {"0": 7926, "Circuit Training": 405, "Martial Arts": 402, "Run": 421, "Sport": 426, "Walk": 420}


def test_golden_lag_counts(spark):
    from pulsekit.operators.features import lag_features
    from pulsekit.plans.context import Inputs
    hourly = Inputs(spark, SF01).hourly_series()
    assert lag_features(hourly, "TS", "BPM", n_lags=60, unit_seconds=3600, bucket_units=24 * 7).count() == 659
    assert E.queries()["lag_features"](spark, SF01).count() == 16204  # per person, by the minute
