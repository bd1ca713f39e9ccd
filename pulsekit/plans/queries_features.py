"""Registered queries: lag features, training matrix and model."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsekit.functions import (NO_LABEL_COLUMN, SPORTS, clock_text, day_text, epoch_micros, hour_text,
                                one_hot_columns, time_as_int, ts_from_day_hour, ts_from_day_time)
from pulsekit.operators import features as FT
from pulsekit.operators import model as M
from pulsekit.operators import stats as ST
from pulsekit.plans.context import Inputs
from pulsekit.plans.queries import query
from pulsekit.session import checkpoint_root, scratch_path

HOUR_S, MINUTE_S = 3600, 60
N_LAGS = 60
# one-week frames (+ 61 h halo) for hourly series, so no series is one task
WEEK_UNITS = 24 * 7


@query
def one_hot_sport(spark, sf_dir):
    lab = Inputs(spark, sf_dir).labelled
    return lab.select("event_id", *one_hot_columns("sport", SPORTS))


@query
def lag_features(spark, sf_dir):
    """Complete rows of every person's device minutes, by the row-based definition."""
    return FT.lag_features(Inputs(spark, sf_dir).device_minutes, "TS", "BPM", n_lags=N_LAGS, unit_seconds=MINUTE_S,
                           series=["user_id"])


@query
def lag_features_frame(spark, sf_dir):
    """The same rows by one range frame per row."""
    return FT.lag_features_frame(Inputs(spark, sf_dir).device_minutes, "TS", "BPM", n_lags=N_LAGS,
                                 unit_seconds=MINUTE_S, series=["user_id"])


@query
def lag_features_by_type(spark, sf_dir):
    """One hourly series per event type, all 60 lags; rows with gaps stay, with nulls."""
    i = Inputs(spark, sf_dir)
    per_type = (i.events.select("event_type", ts_from_day_hour(day_text("ts"), hour_text("ts")).alias("TS"),
                                F.floor("value").cast("int").alias("v"))
                .groupBy("event_type", "TS").agg(F.max("v").alias("BPM")))
    return FT.lag_features(per_type, "TS", "BPM", n_lags=N_LAGS, unit_seconds=HOUR_S,
                           series=["event_type"], dropna=False, bucket_units=WEEK_UNITS)


@query
def lag_features_per_user(spark, sf_dir):
    """One hourly series per user (the source application's per-person
    series), all 60 gap-checked lags; rows with gaps stay, with nulls.  Frames
    of one week per user, so no series is one task."""
    i = Inputs(spark, sf_dir)
    per_user = (i.samples.select("user_id", ts_from_day_hour("date", "HOUR").alias("TS"), "value")
                .groupBy("user_id", "TS").agg(F.max("value").alias("BPM")))
    return FT.lag_features(per_user, "TS", "BPM", n_lags=N_LAGS, unit_seconds=HOUR_S,
                           series=["user_id"], dropna=False, bucket_units=WEEK_UNITS)


@query
def lag_matrix_per_user(spark, sf_dir):
    """Every labelled sample with its person's values of the 60 minutes before
    (the source application's matrix, at the data's own grain), gaps as nulls."""
    lab = Inputs(spark, sf_dir).labelled.select(
        "user_id", "event_id", ts_from_day_time("date", "time").alias("TS"), F.col("value").alias("BPM"), "sport")
    lagged = FT.lag_features(lab, "TS", "BPM", n_lags=N_LAGS, unit_seconds=60, series=["user_id"],
                             tie="event_id", dropna=False)
    return lagged.select("user_id", "event_id", time_as_int(clock_text("TS")).alias("time"),
                         F.col("BPM").cast("int").alias("BPM"),
                         *[F.col(f"`{n}`") for n in FT.lag_names(N_LAGS)], *one_hot_columns("sport", SPORTS))


def _matrix(spark, sf_dir, keep=()):
    """The matrix at the device's grain: every minute of a person after 60 unbroken ones."""
    return FT.training_matrix(Inputs(spark, sf_dir).device_labelled, n_lags=N_LAGS, unit_seconds=MINUTE_S,
                              series=["user_id"], whole_units=True, keep=keep)


@query
def training_matrix(spark, sf_dir):
    return _matrix(spark, sf_dir)


@query
def persistence_mae(spark, sf_dir):
    return ST.mean_absolute_error(_matrix(spark, sf_dir), "BPM", "Min - 1")


@query
def summary_stats(spark, sf_dir):
    """Every column of the per-person matrix, gaps left out."""
    m = lag_matrix_per_user(spark, sf_dir).drop("user_id", "event_id")
    out = ST.summary_stats(m, m.columns)
    return out.select("column", "count", *[F.round(c, 6).alias(c) for c in
                                             ("mean", "std", "min", "p25", "p50", "p75", "max")])


def _split():
    """Train or test by the person and the minute."""
    minute = F.floor(epoch_micros("TS") / F.lit(MINUTE_S * 1_000_000))
    return M.split_column(minute + F.col("user_id") * F.lit(7919))


@query
def train_test_split(spark, sf_dir):
    return Inputs(spark, sf_dir).device_minutes.select("user_id", "TS", "BPM", _split().alias("split"))


def _split_matrix(spark, sf_dir):
    return _matrix(spark, sf_dir, keep=[_split().alias("split")])


@query
def zscore_features(spark, sf_dir):
    """Mean and population std of every feature, fitted on training rows only."""
    m = _split_matrix(spark, sf_dir)
    feats = [c for c in m.columns if c not in ("split", "BPM")]
    fit = M.standardiser_fit(m.filter(F.col("split") == "train"), feats)
    return fit.select("column", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def _landed(df, name):
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query
def standardised_matrix(spark, sf_dir):
    """The test rows in units of the training rows' spread."""
    m = _landed(_split_matrix(spark, sf_dir), "matrix")
    feats = [c for c in m.columns if c not in ("split", "BPM")]
    params = M.collect_params(M.standardiser_fit(m.filter(F.col("split") == "train"), feats))
    z = M.standardise(m.filter(F.col("split") == "test").drop("split"), params)
    return z.select("BPM", *[F.round(F.col(f"`{c}`"), 4).alias(c) for c in feats])


def _models(spark, sf_dir):
    """-> (landed split matrix, {model: scores of its test rows by the saved and loaded model})."""
    checkpoint_root(spark)  # boosting cuts its lineage in the shared checkpoint folder
    m = _landed(_split_matrix(spark, sf_dir), "matrix")  # the fits read it many times
    feats = [c for c in m.columns if c not in ("split", "BPM")]
    train, test = (m.filter(F.col("split") == x) for x in ("train", "test"))
    fits = {"tree": lambda: M.fit_regressor(train, feats),
            "linear": lambda: M.fit_least_absolute(train, feats)}

    def scored(kind):
        model, names = fits[kind]()
        saved = scratch_path(spark, f"model-{kind}")
        M.save_model(model, saved)
        return M.score(M.load_model(saved), names, test, passthrough=[NO_LABEL_COLUMN, *SPORTS])

    return m, scored


@query
def bpm_predict(spark, sf_dir):
    """Train on the training rows, score the test rows with the model as saved and loaded (rows-only check)."""
    return _models(spark, sf_dir)[1]("tree")


def _mae(scored):
    return scored.agg(F.avg(F.abs(F.col("Predict BPM") - F.col("Real BPM")))).scalar()


@query
def model_errors(spark, sf_dir):
    """Mean absolute error on the test rows: persistence (the minute before), the boosted trees, the linear model."""
    m, scored = _models(spark, sf_dir)
    persistence = m.filter(F.col("split") == "test").select(F.col("`Min - 1`").alias("Predict BPM"), F.col("BPM").alias("Real BPM"))
    parts = [df.agg(F.count("*").alias("n_rows"), F.avg(F.abs(F.col("Predict BPM") - F.col("Real BPM"))).alias("mae"))
             .select(F.lit(kind).alias("model"), "n_rows", "mae")
             for kind, df in (("persistence", persistence), ("tree", scored("tree")), ("linear", scored("linear")))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def bpm_predict_check(spark, sf_dir):
    """What is known of the predictions beforehand: their number and the true values of the test rows, that the
    trees stay in the range of the training values, the errors of persistence and of the best constant, and that
    both models' test errors are below that of persistence, which no constant is."""
    m, scored = _models(spark, sf_dir)
    train, test = (m.filter(F.col("split") == x) for x in ("train", "test"))
    known = train.agg(F.min("BPM").alias("lo"), F.max("BPM").alias("hi"), F.median("BPM").alias("mid"))
    lo, hi, mid = (known.select(c).scalar() for c in ("lo", "hi", "mid"))
    persistence = test.agg(F.avg(F.abs(F.col("`Min - 1`") - F.col("BPM")))).scalar()
    constant = test.agg(F.avg(F.abs(F.col("BPM") - mid))).scalar()
    tree, linear = scored("tree"), scored("linear")
    return tree.agg(F.count("*").alias("n_test"), F.sum("Real BPM").cast("bigint").alias("sum_real"),
                    F.bool_and(F.col("Predict BPM").between(lo, hi)).alias("in_range")).select(
        "n_test", "sum_real", "in_range", F.round(persistence, 6).alias("persistence_mae"), F.round(constant, 6).alias("constant_mae"),
        (constant > persistence).alias("constant_fails"), (_mae(tree) < persistence).alias("tree_learned"),
        (_mae(linear) < persistence).alias("linear_learned"))
