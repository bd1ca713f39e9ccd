"""Split, standardisation, regression and batch scoring on MLlib.

The source application trains a small dense network on the driver until the
test error drops under a bound (tuning on the test set).  MLlib has no neural
regressor; the distributed equivalent with the same objective (absolute
error) is a gradient-boosted tree ensemble, chosen by a bounded parameter
grid on a validation split of the training rows, then reported once on the
test rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.operators.stats import column_moments
from pulsekit.session import scratch_path

# Multiplicative hashing constant (Knuth) for the deterministic split.
_MIX = 2654435761
_MOD = 4294967296


def split_column(key: Column, train_percent: int = 80) -> Column:
    """'train' / 'test' from an integer key: reproducible on any engine and
    on any cluster size (unlike ``randomSplit``, which depends on partitioning)."""
    key = F.pmod(key.cast("bigint"), F.lit(_MOD // 2))  # the product stays below 2^63
    bucket = F.pmod(F.pmod(key * F.lit(_MIX), F.lit(_MOD)), F.lit(100))
    return F.when(bucket < train_percent, F.lit("train")).otherwise(F.lit("test"))


def random_split(df: DataFrame, train: float = 0.8, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    tr, te = df.randomSplit([train, 1.0 - train], seed=seed)
    return tr, te


def standardiser_fit(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population std per column (the normalisation layer's statistics),
    fitted on the training rows only (one row per column)."""
    return column_moments(train, columns).drop("count")


def standardise(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    """Apply fitted (mean, std) literals; a zero std leaves the centred value."""
    out = []
    for c in df.columns:
        if c in params:
            mean, std = params[c]
            scaled = (F.col(f"`{c}`") - F.lit(mean)) / F.lit(std if std else 1.0)
            out.append(scaled.alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def collect_params(fit: DataFrame) -> dict[str, tuple[float, float]]:
    """Fitted statistics to the driver: one row per column of the plan, whatever the number of rows."""
    return {r["column"]: (r["mean"], r["std"]) for r in fit.collect()}


def safe_names(columns: Sequence[str]) -> dict[str, str]:
    return {c: f"f{i}" for i, c in enumerate(columns)}


def _written(rows: DataFrame) -> DataFrame:
    path = scratch_path(rows.sparkSession, "assembled")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def fit_regressor(train: DataFrame, features: Sequence[str], label: str = "BPM",
                  max_iter: Sequence[int] = (10, 20), max_depth: Sequence[int] = (3, 5),
                  seed: int = 0, parallelism: int = 2):
    """Pipeline(VectorAssembler, StandardScaler, GBTRegressor(absolute loss)),
    best of a bounded grid on a 80/20 validation split of ``train``.

    The rows are assembled once and landed: every fit of the grid reads them several times."""
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit

    names = safe_names(features)
    renamed = train.select(*[F.col(f"`{c}`").cast("double").alias(n) for c, n in names.items()],
                           F.col(f"`{label}`").cast("double").alias("label"))
    assembler = VectorAssembler(inputCols=list(names.values()), outputCol="raw", handleInvalid="keep")
    rows = _written(assembler.transform(renamed).select("raw", "label"))
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    gbt = GBTRegressor(featuresCol="features", labelCol="label", lossType="absolute", seed=seed,
                       checkpointInterval=10)
    grid = (ParamGridBuilder().addGrid(gbt.maxIter, list(max_iter))
            .addGrid(gbt.maxDepth, list(max_depth)).build())
    tvs = TrainValidationSplit(estimator=Pipeline(stages=[scaler, gbt]),
                               estimatorParamMaps=grid,
                               evaluator=RegressionEvaluator(metricName="mae"),
                               trainRatio=0.8, seed=seed, parallelism=parallelism)
    return PipelineModel(stages=[assembler, *tvs.fit(rows).bestModel.stages]), names


def _normal_sums(batches, line, least_residual: float):
    """Of a task's rows: the weighted products of (1, features, label) by each other, then their number and the sum
    of their absolute residuals, as ``k, s``."""
    import numpy as np
    import pyarrow as pa

    total, n, off = 0.0, 0, 0.0
    for batch in batches:
        if not batch.num_rows:
            continue
        y = batch.column("label").to_numpy(zero_copy_only=False)
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
        z = np.column_stack([np.ones(len(y)), x, y])
        weight = np.ones(len(z))
        if line is not None:
            residual = np.abs(y - z[:, :-1] @ np.asarray(line))
            weight = 1 / np.maximum(residual, least_residual)
            off += residual.sum()
        total, n = total + (z * weight[:, None]).T @ z, n + len(z)
    if n:
        sums = np.append(np.ravel(total), [n, off])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype="int32")), pa.array(sums)], names=["k", "s"])


def _ridge_line(sums, ridge: float):
    """Intercept and slopes from the sums, in standardised units with ``ridge`` as MLlib's normal solver takes it."""
    import numpy as np

    moments = sums / sums[0, 0]
    mean = moments[0]
    cov = moments - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(cov), 0))
    used = [i for i in range(1, len(mean) - 1) if spread[i] > 1e-9 * max(1.0, abs(mean[i]))]
    line = np.zeros(len(mean) - 1)
    if used and spread[-1] > 0:
        corr = cov[np.ix_(used, used)] / np.outer(spread[used], spread[used]) + np.eye(len(used)) * ridge / spread[-1]
        slopes = np.linalg.lstsq(corr, cov[used, -1] / (spread[used] * spread[-1]), rcond=None)[0]
        line[used] = slopes * spread[-1] / spread[used]
    line[0] = mean[-1] - line[1:] @ mean[1:-1]
    return [float(v) for v in line]


def fit_least_absolute(train: DataFrame, features: Sequence[str], label: str = "BPM", rounds: int = 12,
                       least_residual: float = 0.25, gain: float = 1e-3, ridge: float = 1e-6):
    """A linear model of least absolute error, by iteratively reweighted least squares.

    A round weighs every row by 1 / |residual| of the round before (at least ``least_residual``) and solves the
    normal equations, which are summed over the partitions: its state is (features + 2)^2 numbers, whatever
    the number of rows, and one pass over the rows gives a round's error and the next round's sums.  ``ridge``
    keeps them regular where columns depend on each other, as one-hot columns do.  Stops when a round takes
    less than ``gain`` of the mean absolute error off; the model is fitted with the weights of the best round.
    -> (pipeline model, names) as ``fit_regressor``.
    """
    import numpy as np
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    names = safe_names(features)
    assembler = VectorAssembler(inputCols=list(names.values()), outputCol="features")
    rows = assembler.transform(train.select(*[F.col(f"`{c}`").cast("double").alias(n) for c, n in names.items()],
                                            F.col(f"`{label}`").cast("double").alias("label")))
    rows = _written(rows.select("features", F.array(*names.values()).alias("x"), "label"))  # every round reads them
    width = len(names) + 2

    def summed(line):
        sums = (rows.select("x", "label")
                .mapInArrow(partial(_normal_sums, line=line, least_residual=least_residual), "k int, s double")
                .groupBy("k").agg(F.sum("s").alias("s")).collect())
        found = np.full(width * width + 2, np.nan)  # of no rows: nothing is known
        for r in sums:
            found[r["k"]] = r["s"]
        return found[:-2].reshape(width, width), found[-1] / found[-2]

    weigh, line, least = None, None, float("inf")  # the line that gives the best round's weights
    sums, _ = summed(None)
    for _ in range(rounds):
        if not np.isfinite(sums).all():
            break  # no rows: the fit below says so
        before_line, line = line, _ridge_line(sums, ridge)
        sums, error = summed(line)
        improved, before = error < least, least
        if improved:
            weigh, least = before_line, error
        if not improved or before - error < gain * error:
            break
    weight = F.lit(1.0)
    if weigh is not None:
        terms = F.zip_with("x", F.array(*[F.lit(v) for v in weigh[1:]]), lambda x, slope: x * slope)
        predicted = F.aggregate(terms, F.lit(weigh[0]), lambda sofar, v: sofar + v)
        weight = 1 / F.greatest(F.abs(F.col("label") - predicted), F.lit(least_residual))
    solver = LinearRegression(solver="normal", weightCol="weight", regParam=ridge)
    best = solver.fit(rows.select("features", "label", weight.alias("weight")))
    return PipelineModel(stages=[assembler, best]), names


def score(model, names: dict[str, str], df: DataFrame, label: str = "BPM",
          passthrough: Sequence[str] = ()) -> DataFrame:
    """``Predict BPM`` (rounded half-to-even), ``Real BPM``, then ``passthrough``."""
    ready = df.select(*[F.col(f"`{c}`").cast("double").alias(n) for c, n in names.items()],
                      F.col(f"`{label}`").alias("_real"),
                      *[F.col(f"`{c}`").alias(f"_p{i}") for i, c in enumerate(passthrough)])
    scored = model.transform(ready)
    return scored.select(F.bround("prediction").cast("int").alias("Predict BPM"),
                         F.col("_real").cast("int").alias("Real BPM"),
                         *[F.col(f"_p{i}").alias(c) for i, c in enumerate(passthrough)])


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
