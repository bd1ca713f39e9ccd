"""Split, standardisation, rounding, regression (FIXTURES §4.12)."""

import pytest
from pyspark.sql import functions as F

from pulsekit.operators import model as M


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(72.5,), (73.5,)], "p double")
    assert [r[0] for r in df.select(F.bround("p").cast("int")).collect()] == [72, 74]


def test_split_is_deterministic_and_about_80_percent(spark):
    df = spark.range(0, 5000)
    a = df.select(M.split_column(F.col("id")).alias("s")).groupBy("s").count().collect()
    share = {r.s: r["count"] for r in a}
    assert 0.75 < share["train"] / 5000 < 0.85
    b = df.repartition(7).select("id", M.split_column(F.col("id")).alias("s"))
    c = df.select("id", M.split_column(F.col("id")).alias("s"))
    assert b.exceptAll(c).count() == 0


def test_standardise_uses_train_statistics(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    params = M.collect_params(M.standardiser_fit(df, ["x"]))
    assert params == {"x": (2.0, 1.0)}
    assert [r.x for r in M.standardise(df, params).collect()] == [-1.0, 1.0]


def test_regressor_trains_and_scores(spark, tmp_dir):
    rows = [(float(i % 50), float((i * 7) % 13), 60 + (i % 50)) for i in range(400)]
    df = spark.createDataFrame(rows, "a double, b double, BPM int")
    model, names = M.fit_regressor(df, ["a", "b"], max_iter=(5,), max_depth=(3,))
    out = M.score(model, names, df, passthrough=["a"])
    assert out.columns == ["Predict BPM", "Real BPM", "a"]
    mae = out.select(F.avg(F.abs(F.col("Predict BPM") - F.col("Real BPM")))).collect()[0][0]
    assert mae < 5
    path = tmp_dir + "/model"
    M.save_model(model, path)
    assert M.load_model(path).transform is not None


def test_random_split_partitions_all_rows(spark):
    df = spark.range(0, 1000)
    train, test = M.random_split(df, 0.8, seed=0)
    assert train.count() + test.count() == 1000
    assert train.join(test, "id").count() == 0


def test_least_absolute_is_not_moved_by_outliers(spark, tmp_dir):
    import random
    rng = random.Random(2)
    rows = []
    for i in range(2000):
        a, b = rng.random() * 50, rng.random() * 10
        far = 400 if i % 10 == 0 else 0  # a tenth of the labels is far off, all to one side
        rows.append((a, b, int(i % 2 == 0), int(i % 2 == 1), 60 + 2 * a - 3 * b + far))
    df = spark.createDataFrame(rows, "a double, `b c` double, h0 int, h1 int, BPM double")
    model, names = M.fit_least_absolute(df, ["a", "b c", "h0", "h1"])
    line = model.stages[-1]
    assert abs(line.coefficients[0] - 2) < 0.05 and abs(line.coefficients[1] + 3) < 0.1
    path = tmp_dir + "/linear"
    M.save_model(model, path)
    out = M.score(M.load_model(path), names, df.filter("BPM < 250"))
    assert out.select(F.avg(F.abs(F.col("Predict BPM") - F.col("Real BPM")))).first()[0] < 1.5


def test_split_of_large_keys(spark):
    df = spark.createDataFrame([(2 ** 62,), (-5,), (7,)], "id long")
    got = [r.s for r in df.select(M.split_column(F.col("id")).alias("s")).collect()]
    assert set(got) <= {"train", "test"}


def test_summed_rounds_give_the_weighted_model(spark):
    """The rounds' sums against the normal solver itself, round by round; dependent columns and a constant one."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    rows = [(float(i % 37), float((i * 11) % 23), int(i % 2 == 0), int(i % 2 == 1), 5.0, 40 + 2.0 * (i % 37) + (i * 7919) % 13) for i in range(600)]
    feats = ["a", "b", "h0", "h1", "c"]
    df = spark.createDataFrame(rows, "a double, b double, h0 int, h1 int, c double, BPM double")
    model, _ = M.fit_least_absolute(df, feats, rounds=2)
    x = VectorAssembler(inputCols=feats, outputCol="features").transform(df).withColumnRenamed("BPM", "label")
    solver = LinearRegression(solver="normal", weightCol="weight", regParam=1e-6)
    plain = solver.fit(x.withColumn("weight", F.lit(1.0)))
    off = F.greatest(F.abs(F.col("label") - F.col("prediction")), F.lit(0.25))
    second = solver.fit(plain.transform(x).select("features", "label", (1 / off).alias("weight")))

    def error(m):
        return m.transform(x).agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]

    want = second if error(second) < error(plain) else plain
    assert all(abs(p - q) < 1e-4 for p, q in zip(model.stages[-1].coefficients, want.coefficients))


def test_rounds_read_landed_arrays(spark):
    seen = []
    written = M._written
    M._written = lambda rows: seen.append(rows.columns) or written(rows)
    try:
        M.fit_least_absolute(spark.range(50).selectExpr("cast(id as double) a", "2.0 * id BPM"), ["a"])
    finally:
        M._written = written
    assert seen == [["features", "x", "label"]]  # assembled once, not in every pass


@pytest.mark.parametrize("name", ["bpm_predict", "model_errors"])
def test_predictions_come_from_the_whole_grid(spark, tmp_dir, monkeypatch, name):
    """The queries on models search every point of the operator's grid and keep all rounds of the best one."""
    from datetime import datetime

    from pyspark.ml.tuning import TrainValidationSplit

    import __spark_entry__ as E
    rows = [(i, datetime(2024, 1, 1 + i, 8, 0, 30), i % 2, "purchase", 7.5 * i, '{"k": 150}') for i in range(4)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
                                "props string").write.parquet(f"{tmp_dir}/events.parquet")
    points, rounds = [], []
    fit, save = TrainValidationSplit.fit, M.save_model

    def seen_fit(self, dataset):
        points.extend({p.name: v for p, v in point.items()} for point in self.getEstimatorParamMaps())
        return fit(self, dataset)

    def seen_save(model, path):
        rounds.extend([model.stages[-1].getNumTrees] if hasattr(model.stages[-1], "trees") else [])
        save(model, path)

    monkeypatch.setattr(TrainValidationSplit, "fit", seen_fit)
    monkeypatch.setattr(M, "save_model", seen_save)
    assert E.queries()[name](spark, tmp_dir).count() > 0
    assert sorted((p["maxIter"], p["maxDepth"]) for p in points) == [(10, 3), (10, 5), (20, 3), (20, 5)]
    assert rounds in ([10], [20])
