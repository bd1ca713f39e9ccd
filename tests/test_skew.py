"""Hot keys: one user, or even one (user, minute), holding a third of all samples.

The labelling joins are keyed on (user, day, minute), so a hot user already
spreads over many partitions.  A hot single minute lands in one partition:
for the fan-out join AQE splits that partition of the samples side and
replicates the matching minutes.  The last-wins join is many-to-one (its
right side is the reduction's output, one row per key): a hot minute is
one long streaming task with one matching row in memory; results stay
exactly the same in every case.
"""

from pulsekit.operators import label as L


def _data(spark, hot_minute: bool):
    rows = []
    for i in range(3000):
        if i % 3 == 0:
            user, time = 1, ("10:05:00" if hot_minute else f"{(i // 60) % 24:02d}:{i % 60:02d}:00")
        else:
            user, time = 2 + i % 50, f"{(i // 60) % 24:02d}:{i % 60:02d}:00"
        rows.append((user, i, time, 60 + i % 40, "2023-02-11", time[:2]))
    samples = spark.createDataFrame(rows, "user_id long, event_id long, time string, value int, date string, HOUR string")
    acts = [(u, 100 + u * 10 + k, ["Run", "Walk"][k % 2], 30 * 60_000, f"2023-02-11T{(k * 3 + 10) % 24:02d}:05:00.000+02:00")
            for u in range(1, 52) for k in range(4)]
    log = spark.createDataFrame(acts, "user_id long, logId long, activityName string, originalDuration long, "
                                      "originalStartTime string")
    return samples, L.activity_intervals(log, ["user_id"])


def _run_with(spark, conf, fn):
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return fn()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SKEW_CONF = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.shuffle.partitions": "16"}


def _label(samples, intervals, op=L.label_last_wins):
    out = op(samples, intervals, ["user_id"])
    rows = sorted(map(tuple, out.collect()))
    return rows, out._jdf.queryExecution().executedPlan().toString()


def test_hot_minute_fanout_join_is_split(spark):
    samples, intervals = _data(spark, hot_minute=True)
    expected, _ = _label(samples, intervals, L.label_fanout)
    got, plan = _run_with(spark, SKEW_CONF, lambda: _label(samples, intervals, L.label_fanout))
    assert got == expected
    assert "skew=true" in plan, plan


def test_hot_minute_last_wins_unchanged(spark):
    samples, intervals = _data(spark, hot_minute=True)
    expected, _ = _label(samples, intervals)
    got, _ = _run_with(spark, SKEW_CONF, lambda: _label(samples, intervals))
    assert got == expected
    hot = [r for r in got if r[0] == 1 and r[2] == "10:05:00"]
    assert len(hot) == 1000 and {r[-1] for r in hot} == {"Run"}


def test_hot_user_spreads_without_skew_handling(spark):
    samples, intervals = _data(spark, hot_minute=False)
    expected, _ = _label(samples, intervals, L.label_fanout)
    got, plan = _run_with(spark, SKEW_CONF, lambda: _label(samples, intervals, L.label_fanout))
    assert got == expected
    assert "skew=true" not in plan
