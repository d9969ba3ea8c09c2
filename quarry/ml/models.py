"""Regression on DataFrames with Spark ML.

Estimators fit with distributed passes (tree aggregates); transforms are
column expressions.  Metrics are returned as one-row DataFrames computed
with built-in aggregates, so nothing but the model itself reaches the driver.

Defects of the original programs that are *not* repeated here: the test set
is scaled with the scaler fitted on the training set; a random-forest score
uses the forest's own predictions; a pipeline's regression reads the scaled
features it builds.
"""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import (GeneralizedLinearRegression, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import shared_dir


# ------------------------------------------------------------------ splits
def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """Spark's per-partition Bernoulli split: reproducible only for the same
    partitioning of the input (M1)."""
    return df.randomSplit(list(weights), seed=seed)


def hash_bucket(key: str | list[str], seed: int = 42, buckets: int = 100) -> Column:
    """A bucket from the MD5 of seed and key texts, which any engine can repeat."""
    keys = [key] if isinstance(key, str) else key
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets


def hash_split(df: DataFrame, key: str | list[str], train_pct: int = 80,
               seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Stable split by a hash of the key: the same rows land in the same
    part whatever the partitioning or cluster size."""
    bucket = hash_bucket(key, seed)
    return df.where(bucket < train_pct), df.where(bucket >= train_pct)


def time_cut(df: DataFrame, ts: str, tenths: int = 8) -> Column:
    """The value of ``ts`` after which ``tenths`` tenths of its span have passed
    (an aggregate; exact, so every branch and engine cuts alike)."""
    is_time = dict(df.dtypes)[ts].startswith("timestamp")
    number = F.unix_micros(F.col(ts).cast("timestamp")) if is_time else F.col(ts).cast("bigint")
    low, high = df.agg(F.min(number), F.max(number)).first()
    cut = (low or 0) + ((high or 0) - (low or 0)) * tenths // 10
    return F.timestamp_micros(F.lit(cut)) if is_time else F.lit(cut)


def time_split(df: DataFrame, ts: str, tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    """Train on the first ``tenths`` tenths of the time span, test on the rest
    -- no look-ahead leakage."""
    cut = time_cut(df, ts, tenths)
    return df.where(F.col(ts) <= cut), df.where(F.col(ts) > cut)


# ---------------------------------------------------------------- features
def assembler(inputs: list[str], out: str = "Features", handle_invalid: str = "error") -> VectorAssembler:
    """Rows with a null or NaN input raise; ``"skip"`` drops them, ``"keep"`` keeps
    them as NaN, on request (M2)."""
    return VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid=handle_invalid)


def scaler(inp: str = "Features", out: str = "scaledFeatures") -> StandardScaler:
    """Mean 0, unit sample standard deviation (M3)."""
    return StandardScaler(inputCol=inp, outputCol=out, withMean=True, withStd=True)


def vector_columns(df: DataFrame, vec: str, names: list[str]) -> list[Column]:
    arr = vector_to_array(F.col(vec))
    return [arr[i].alias(n) for i, n in enumerate(names)]


# Iterations, regularisation and mixing of the elastic net, and
# iterations of the gamma regression.
ELASTIC_NET_ITER, ELASTIC_NET_REG, ELASTIC_NET_MIX = 10, 0.3, 0.8
GAMMA_ITER = 20


# ------------------------------------------------------------------ models
def linear_regression(features: str = "Features", label: str = "Close", max_iter: int = ELASTIC_NET_ITER,
                      reg: float = ELASTIC_NET_REG, elastic_net: float = ELASTIC_NET_MIX, solver: str = "auto") -> LinearRegression:
    return LinearRegression(featuresCol=features, labelCol=label, maxIter=max_iter,
                            regParam=reg, elasticNetParam=elastic_net, solver=solver)


def ols(features: str = "Features", label: str = "Close") -> LinearRegression:
    """Ordinary least squares: one normal-equation pass over the data."""
    return LinearRegression(featuresCol=features, labelCol=label, regParam=0.0, solver="normal")


def gamma_glm(features: str = "Features", label: str = "Close", max_iter: int = GAMMA_ITER,
              tol: float = 1e-6) -> GeneralizedLinearRegression:
    """Gamma family, default (inverse) link (M8)."""
    return GeneralizedLinearRegression(featuresCol=features, labelCol=label, family="gamma", maxIter=max_iter, tol=tol)


def random_forest(features: str = "Features", label: str = "Close", seed: int = 42) -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol=features, labelCol=label, seed=seed)


def staged_regression(inputs: list[str], label: str, **lr_params) -> Pipeline:
    """assembler -> scaler -> regression on the scaled features."""
    return Pipeline(stages=[assembler(inputs), scaler(),
                            linear_regression("scaledFeatures", label, **lr_params)])


def save(model: PipelineModel, name: str) -> str:
    """Save a fitted pipeline in the shared folder; returns its path."""
    spark = SparkSession.getActiveSession()
    path = f"{shared_dir(spark, 'models')}/{name}-{uuid.uuid4().hex[:8]}"
    model.write().save(path)
    return path


def load(path: str) -> PipelineModel:
    """A saved pipeline; it transforms batch and streaming DataFrames alike."""
    return PipelineModel.load(path)


# ----------------------------------------------------------------- read-out
def coefficients(spark: SparkSession, model, names: list[str]) -> DataFrame:
    """One row per term: (term, value); the intercept is a term (M6)."""
    rows = [(n, float(c)) for n, c in zip(names, model.coefficients.toArray())]
    rows.append(("intercept", float(model.intercept)))
    return spark.createDataFrame(rows, "term STRING, value DOUBLE")


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction",
                       n_features: int = 1) -> DataFrame:
    """MSE, R^2 and adjusted R^2 as a one-row DataFrame."""
    y, p = F.col(label).cast("double"), F.col(prediction)
    stats = pred.agg(F.count(y).alias("n"), F.avg((y - p) * (y - p)).alias("mse"),
                     F.sum((y - p) * (y - p)).alias("sse"), F.var_pop(y).alias("vy"))
    r2 = 1 - F.col("sse") / (F.col("vy") * F.col("n"))
    r2adj = 1 - (1 - r2) * (F.col("n") - 1) / (F.col("n") - n_features - 1)
    return stats.select("n", "mse", r2.alias("r2"), r2adj.alias("r2adj"))


def evaluator_r2(pred: DataFrame, label: str) -> float:
    return RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="r2").evaluate(pred)


def glm_summary(spark: SparkSession, model, data: DataFrame, names: list[str]) -> DataFrame:
    """Coefficients plus deviance and dispersion of the fitted GLM (M9)."""
    s = model.evaluate(data)
    rows = [(n, float(c)) for n, c in zip(names, model.coefficients.toArray())]
    rows += [("intercept", float(model.intercept)), ("deviance", float(s.deviance)),
             ("dispersion", float(s.dispersion))]
    return spark.createDataFrame(rows, "term STRING, value DOUBLE")


def sequences_to_vectors(df: DataFrame, history: str = "history", out: str = "Features") -> DataFrame:
    """array<double> history -> ML vector, for autoregression."""
    return df.withColumn(out, array_to_vector(F.transform(history, lambda x: x.cast("double"))))


__all__ = [
    "Pipeline", "PipelineModel", "random_split", "hash_bucket", "hash_split", "time_cut", "time_split", "assembler", "scaler",
    "vector_columns", "linear_regression", "ols", "gamma_glm", "random_forest", "staged_regression", "save", "load",
    "coefficients", "regression_metrics", "evaluator_r2", "glm_summary", "sequences_to_vectors",
]
