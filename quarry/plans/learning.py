"""Machine-learning queries (M1-M15) on the prices CSV (from `part`) and
on series windows (from `events`)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quarry.ml import models as ml
from quarry.ml import recurrent
from quarry.operators import windows
from quarry.plans.documents import prices
from quarry.plans.registry import query
from quarry.session import materialize, write_table
from quarry.sources import fixtures, readers, schemas
from quarry.streaming import runner

FEATURES = ["Open", "High", "Low"]
#: Steps of a window that the autoregression looks back on.
HISTORY = 50

# Single-feature least squares (Close ~ High) in SQL, for the oracles.
_OLS_SQL = """
WITH d AS (SELECT DATE '1990-01-01' + CAST(p_partkey AS INTEGER) AS Date,
                  CAST(CAST(p_partkey AS FLOAT) AS DOUBLE) AS x,
                  CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS y FROM part),
m AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, count(*) AS n FROM d),
p AS (SELECT d.Date, d.x, d.y, m.intercept + m.slope * d.x AS prediction FROM d, m)
"""


def _ols_fit(spark: SparkSession, sf_dir: str):
    data = ml.assembler(["High"]).transform(prices(spark, sf_dir))
    model = ml.ols().fit(data)
    return model, model.transform(data)


@query("linreg_ols", _OLS_SQL + """
SELECT 'High' AS feature, round(slope, 6) AS slope, round(intercept, 6) AS intercept FROM m""")
def linreg_ols(spark, sf_dir):
    """M4 (regParam 0) + M6: least-squares slope and intercept."""
    model, _ = _ols_fit(spark, sf_dir)
    coef = ml.coefficients(spark, model, ["High"])
    return (coef.groupBy().agg(F.max(F.when(F.col("term") == "High", F.col("value"))).alias("slope"),
                               F.max(F.when(F.col("term") == "intercept", F.col("value"))).alias("intercept"))
            .select(F.lit("High").alias("feature"), F.round("slope", 6).alias("slope"),
                    F.round("intercept", 6).alias("intercept")))


@query("ml_predict", _OLS_SQL + "SELECT Date, round(prediction, 4) AS prediction FROM p")
def ml_predict(spark, sf_dir):
    """``transform`` adds a prediction per row."""
    _, pred = _ols_fit(spark, sf_dir)
    return pred.select("Date", F.round("prediction", 4).alias("prediction"))


@query("regression_metrics", _OLS_SQL + """
, s AS (SELECT count(*) AS n, avg((y - prediction) * (y - prediction)) AS mse,
               1 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(*)) AS r2 FROM p)
SELECT n, round(mse, 6) AS mse, round(r2, 6) AS r2,
       round(1 - (1 - r2) * (n - 1) / (n - 2), 6) AS r2adj FROM s""")
def regression_metrics(spark, sf_dir):
    """M7: MSE, R^2, adjusted R^2 of the fitted model."""
    _, pred = _ols_fit(spark, sf_dir)
    m = ml.regression_metrics(pred, "Close", n_features=1)
    return m.select("n", *[F.round(c, 6).alias(c) for c in ("mse", "r2", "r2adj")])


@query("r2_metric", _OLS_SQL + """
SELECT round(1 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(*)), 6) AS r2 FROM p""")
def r2_metric(spark, sf_dir):
    """R^2 of the predictions, in the pass that makes them."""
    _, pred = _ols_fit(spark, sf_dir)
    return ml.regression_metrics(pred, "Close").select(F.round("r2", 6).alias("r2"))


@query("standard_scale", """
WITH d AS (SELECT DATE '1990-01-01' + CAST(p_partkey AS INTEGER) AS Date,
                  CAST(CAST(p_size AS FLOAT) AS DOUBLE) AS o, CAST(CAST(p_partkey AS FLOAT) AS DOUBLE) AS h,
                  CAST(CAST(length(p_name) AS FLOAT) AS DOUBLE) AS l FROM part)
SELECT Date, round((o - avg(o) OVER ()) / stddev_samp(o) OVER (), 4) AS open_z,
       round((h - avg(h) OVER ()) / stddev_samp(h) OVER (), 4) AS high_z,
       round((l - avg(l) OVER ()) / stddev_samp(l) OVER (), 4) AS low_z FROM d""")
def standard_scale(spark, sf_dir):
    """M2 + M3: assemble three columns and standardize them."""
    data = ml.assembler(FEATURES).transform(prices(spark, sf_dir))
    scaled = ml.scaler().fit(data).transform(data)
    cols = ml.vector_columns(scaled, "scaledFeatures", ["open_z", "high_z", "low_z"])
    return scaled.select("Date", *[F.round(c, 4).alias(n) for c, n in
                                   zip(cols, ["open_z", "high_z", "low_z"])])


# ------------------------------------------------------ split and held out
_PART_SQL = """
WITH d AS (SELECT DATE '1990-01-01' + CAST(p_partkey AS INTEGER) AS Date,
                  CAST(CAST(p_partkey AS FLOAT) AS DOUBLE) AS x,
                  CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS y FROM part),
s AS (SELECT *, CASE WHEN CAST('0x' || substr(md5('42|' || CAST(Date AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80
                     THEN 'train' ELSE 'test' END AS part FROM d)
"""


@query("random_split", _PART_SQL + "SELECT Date, part AS hash_part FROM s")
def random_split(spark, sf_dir):
    """M1: the 80/20 split by a hash of the key: random, and the same on any
    cluster (Spark's own ``randomSplit`` is ``ml.random_split``)."""
    train, test = ml.hash_split(prices(spark, sf_dir), "Date")
    return (train.select("Date", F.lit("train").alias("hash_part"))
            .unionByName(test.select("Date", F.lit("test").alias("hash_part"))))


@query("model_coefficients", _PART_SQL + f"""
, m AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, stddev_samp(x) AS sx, stddev_samp(y) AS sy,
               corr(x, y) * (count(*) - 1) / count(*) AS r FROM s WHERE part = 'train'),
b AS (SELECT *, sign(r) * greatest(abs(r) - {ml.ELASTIC_NET_REG} * {ml.ELASTIC_NET_MIX} / sy, 0)
                / ((n - 1) / n + {ml.ELASTIC_NET_REG} * (1 - {ml.ELASTIC_NET_MIX}) / sy) AS z FROM m)
SELECT 'High' AS term, 'raw' AS features, round(z * sy / sx, 4) AS value FROM b UNION ALL
SELECT 'intercept', 'raw', round(my - z * sy / sx * mx, 2) FROM b UNION ALL
SELECT 'High', 'scaled', round(z * sy, 4) FROM b UNION ALL
SELECT 'intercept', 'scaled', round(my, 2) FROM b""")
def model_coefficients(spark, sf_dir):
    """M4 + M5 + M6: elastic-net regression (maxIter 10, reg 0.3, mix 0.8) on a
    raw and a scaled feature (scaler fitted on the training part)."""
    data = ml.assembler(["High"]).transform(prices(spark, sf_dir))
    train, _ = ml.hash_split(data, "Date")
    sc = ml.scaler().fit(train)
    raw = ml.linear_regression().fit(train)
    scaled = ml.linear_regression("scaledFeatures").fit(sc.transform(train))
    out = (ml.coefficients(spark, raw, ["High"]).withColumn("features", F.lit("raw"))
           .unionByName(ml.coefficients(spark, scaled, ["High"]).withColumn("features", F.lit("scaled"))))
    return out.withColumn("value", F.when(F.col("term") == "intercept", F.round("value", 2))
                          .otherwise(F.round("value", 4)))


def _elastic_nets(spark: SparkSession, sf_dir: str):
    """Predictions of the raw and the scaled elastic net for the test part."""
    data = ml.assembler(FEATURES).transform(prices(spark, sf_dir))
    train, test = ml.hash_split(data, "Date")
    sc = ml.scaler().fit(train)
    yield "raw", ml.linear_regression().fit(train).transform(test)
    yield "scaled", ml.linear_regression("scaledFeatures").fit(sc.transform(train)).transform(sc.transform(test))


@query("holdout_metrics")
def holdout_metrics(spark, sf_dir):
    """M7 + M12: mean squared error, R^2 and adjusted R^2 on held-out rows of
    the raw and scaled elastic nets, the pipeline, the forest and telemetry."""
    found = [(name, pred, "Close", len(FEATURES)) for name, pred in _elastic_nets(spark, sf_dir)]
    train, test = ml.hash_split(prices(spark, sf_dir), "Date")
    found.append(("pipeline", ml.staged_regression(FEATURES, "Close").fit(train).transform(test), "Close", 3))
    found.append(("forest", _forest(spark, sf_dir), "Close", 3))
    train, test = _telemetry(spark, sf_dir)
    model = ml.staged_regression(["Timestamp", "IntegerValue"], "FloatValue").fit(train)
    found.append(("telemetry", model.transform(test), "FloatValue", 2))
    parts = [ml.regression_metrics(pred, label, n_features=k).withColumn("model", F.lit(name))
             for name, pred, label, k in found]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _irls_sql(steps: int) -> str:
    """Coefficients of a gamma regression (inverse link) of y on x, by ``steps``
    weighted least squares: weights mu^2, working response eta - (y - mu) / mu^2."""
    parts = ["w0 AS (SELECT x, y, y * y AS w, 1 / y AS z FROM t)"]
    for k in range(steps):
        parts.append(f"""
b{k} AS (SELECT (sum(w) * sum(w * x * z) - sum(w * x) * sum(w * z)) / (sum(w) * sum(w * x * x) - sum(w * x) * sum(w * x)) AS slope,
       sum(w * z) / sum(w) AS zm, sum(w * x) / sum(w) AS xm FROM w{k}),
w{k + 1} AS (SELECT x, y, 1 / (eta * eta) AS w, eta - (y - 1 / eta) * eta * eta AS z, eta
             FROM (SELECT x, y, zm + slope * (x - xm) AS eta FROM t, b{k}))""")
    return ", ".join(parts) + f""",
dv AS (SELECT 2 * sum(-ln(y * eta) + y * eta - 1) AS deviance, sum((y * eta - 1) * (y * eta - 1)) / (count(*) - 2) AS dispersion
      FROM w{steps})
SELECT 'High' AS term, round(slope * 1e9, 2) AS value FROM b{steps - 1} UNION ALL
SELECT 'intercept', round((zm - slope * xm) * 1e6, 4) FROM b{steps - 1} UNION ALL
SELECT 'deviance', round(deviance, 4) FROM dv UNION ALL SELECT 'dispersion', round(dispersion, 6) FROM dv"""


@query("glm_gamma_single", _PART_SQL + ", t AS (SELECT x, y FROM s WHERE part = 'train'), " + _irls_sql(12))
def glm_gamma_single(spark, sf_dir):
    """M8 + M9: gamma regression (inverse link) on one feature: coefficients
    (intercept in millionths, slope in billionths), deviance and dispersion."""
    data = ml.assembler(["High"]).transform(prices(spark, sf_dir))
    train = materialize(ml.hash_split(data, "Date")[0])
    out = ml.glm_summary(spark, ml.gamma_glm(tol=1e-12).fit(train), train, ["High"])
    return out.select("term", F.when(F.col("term") == "High", F.round(F.col("value") * 1e9, 2))
                      .when(F.col("term") == "intercept", F.round(F.col("value") * 1e6, 4))
                      .when(F.col("term") == "deviance", F.round("value", 4))
                      .otherwise(F.round("value", 6)).alias("value"))


@query("elastic_net_coefficients")
def elastic_net_coefficients(spark, sf_dir):
    """M4 + M5 + M6: coefficients of the elastic nets on all three features, raw
    and scaled."""
    data = ml.assembler(FEATURES).transform(prices(spark, sf_dir))
    train, _ = ml.hash_split(data, "Date")
    sc = ml.scaler().fit(train)
    raw = ml.linear_regression().fit(train)
    scaled = ml.linear_regression("scaledFeatures").fit(sc.transform(train))
    return (ml.coefficients(spark, raw, FEATURES).withColumn("features", F.lit("raw"))
            .unionByName(ml.coefficients(spark, scaled, FEATURES).withColumn("features", F.lit("scaled"))))


@query("glm_gamma")
def glm_gamma(spark, sf_dir):
    """M8 + M9: gamma GLM (inverse link), coefficients, deviance, dispersion."""
    data = ml.assembler(FEATURES).transform(prices(spark, sf_dir))
    train, test = ml.hash_split(data, "Date")
    # IRLS makes one pass per iteration and does not cache its input
    model = ml.gamma_glm().fit(materialize(train))
    return ml.glm_summary(spark, model, test, FEATURES)


def _forest(spark: SparkSession, sf_dir: str):
    data = ml.assembler(FEATURES).transform(prices(spark, sf_dir))
    train, test = ml.hash_split(data, "Date")
    return ml.random_forest().fit(train).transform(test)


@query("rf_regression")
def rf_regression(spark, sf_dir):
    """The random forest's prediction of every test row; scores are in
    ``holdout_metrics``."""
    return _forest(spark, sf_dir).select("Date", "Close", F.round("prediction", 4).alias("prediction"))


@query("rf_predictions")
def rf_predictions(spark, sf_dir):
    """The forest's predictions beside the errors they make."""
    return rf_regression(spark, sf_dir).withColumn("error", F.round(F.col("prediction") - F.col("Close"), 4))


@query("ml_fit_transform", _PART_SQL + """
, m AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM s WHERE part = 'train')
SELECT Date, CAST(y AS FLOAT) AS Close, round(intercept + slope * x, 4) AS prediction FROM s, m
WHERE part = 'test'""")
def ml_fit_transform(spark, sf_dir):
    """Assembler -> scaler -> regression, fitted once, applied to test."""
    train, test = ml.hash_split(prices(spark, sf_dir), "Date")
    model = ml.staged_regression(["High"], "Close", reg=0.0, solver="normal").fit(train)
    return model.transform(test).select("Date", "Close", F.round("prediction", 4).alias("prediction"))


@query("pipeline_predictions")
def pipeline_predictions(spark, sf_dir):
    """The pipeline on all three features with the elastic net, fitted
    once and applied to the test rows."""
    train, test = ml.hash_split(prices(spark, sf_dir), "Date")
    model = ml.staged_regression(FEATURES, "Close").fit(train)
    return model.transform(test).select("Date", "Close", F.round("prediction", 4).alias("prediction"))


@query("ml_stream_predict", _PART_SQL + """
, m AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM s WHERE part = 'train')
SELECT Date, CAST(y AS FLOAT) AS Close, round(intercept + slope * x, 4) AS prediction FROM s, m
WHERE part = 'test'""")
def ml_stream_predict(spark, sf_dir):
    """Fitted once in batch, saved, loaded, and applied to a stream of prices."""
    train, _ = ml.hash_split(prices(spark, sf_dir), "Date")
    path = ml.save(ml.staged_regression(["High"], "Close", reg=0.0, solver="normal").fit(train), "prices")
    stream = runner.file_stream(spark, fixtures.prices_csv(spark, sf_dir), None, "csv", schemas.PRICES_CSV_SCHEMA,
                                header=True, sep=",")
    predicted = ml.load(path).transform(ml.hash_split(stream, "Date")[1])
    out = runner.run(predicted.select("Date", "Close", "prediction"), "model_stream").table()
    return out.select("Date", "Close", F.round("prediction", 4).alias("prediction"))


def _telemetry(spark: SparkSession, sf_dir: str):
    tel = readers.read_csv(spark, fixtures.telemetry_csv(spark, sf_dir), schemas.TELEMETRY_CSV_SCHEMA)
    return ml.time_split(tel, "Timestamp")


@query("telemetry_regression", """
WITH d AS (SELECT 'evt' || event_id AS Name, CAST(epoch_us(ts) // 1000000 AS INTEGER) AS Timestamp,
                  CAST(value AS FLOAT) AS FloatValue, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS x
           FROM events),
c AS (SELECT min(Timestamp) + (max(Timestamp) - min(Timestamp)) * 8 // 10 AS cut FROM d),
m AS (SELECT regr_slope(CAST(FloatValue AS DOUBLE), x) AS slope,
             regr_intercept(CAST(FloatValue AS DOUBLE), x) AS intercept FROM d, c WHERE Timestamp <= cut)
SELECT Name, Timestamp, FloatValue, round(intercept + slope * x, 4) AS prediction FROM d, c, m
WHERE Timestamp > cut""")
def telemetry_regression(spark, sf_dir):
    """The same pipeline on satellite telemetry, split by time."""
    train, test = _telemetry(spark, sf_dir)
    model = ml.staged_regression(["IntegerValue"], "FloatValue", reg=0.0, solver="normal").fit(train)
    return model.transform(test).select("Name", "Timestamp", "FloatValue",
                                        F.round("prediction", 4).alias("prediction"))


@query("telemetry_predictions")
def telemetry_predictions(spark, sf_dir):
    """The elastic net on both features of the telemetry, split by time."""
    train, test = _telemetry(spark, sf_dir)
    model = ml.staged_regression(["Timestamp", "IntegerValue"], "FloatValue").fit(train)
    return model.transform(test).select("Name", "Timestamp", "FloatValue",
                                        F.round("prediction", 4).alias("prediction"))


def _windows(spark: SparkSession, sf_dir: str, history: int = HISTORY):
    """Windows per user, written once as arrays: those up to the cut in time and those after it."""
    ev = fixtures.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    cut = ml.time_cut(ev, "ts").cast("timestamp_ntz")       # from the events, before they become windows
    seq = write_table(windows.sequence_windows(ev, ["user_id"], ["ts", "event_id"], "value", history), "sequences")
    return seq.where(F.col("ts") <= cut), seq.where(F.col("ts") > cut)


def _forecast(spark: SparkSession, sf_dir: str, history: int = HISTORY):
    """Linear autoregression on windows per user; predictions for the last fifth of the time."""
    early, later = _windows(spark, sf_dir, history)
    model = ml.ols("Features", "target").fit(ml.sequences_to_vectors(early))     # one pass
    return model.transform(ml.sequences_to_vectors(later))


@query("ar_forecast")
def ar_forecast(spark, sf_dir):
    """The forecast of every window of 50 steps in the last fifth of the
    time; scores are in ``forecast_metrics``."""
    return _forecast(spark, sf_dir).select("user_id", "ts", "event_id", "target",
                                           F.round("prediction", 4).alias("prediction"))


@query("ar_predictions")
def ar_predictions(spark, sf_dir):
    """The forecasts beside the errors they make."""
    return ar_forecast(spark, sf_dir).withColumn("error", F.round(F.col("prediction") - F.col("target"), 4))


#: Steps that the recurrent network looks back on and training steps (one job each).
RECURRENT_HISTORY, RECURRENT_STEPS = 20, 15


@query("rnn_forecast")
def rnn_forecast(spark, sf_dir):
    """A recurrent network's forecast of the same rows from windows of 20
    steps, trained data-parallel on the earlier ones."""
    early, later = _windows(spark, sf_dir, RECURRENT_HISTORY)
    model = recurrent.fit(early, steps=RECURRENT_STEPS)
    return model.transform(later).select("user_id", "ts", "event_id", "target",
                                         F.round("prediction", 4).alias("prediction"))


@query("forecast_metrics")
def forecast_metrics(spark, sf_dir):
    """Mean squared error, R^2 and adjusted R^2 of the forecasts, which
    are all of later windows than the model was fitted on."""
    return ml.regression_metrics(_forecast(spark, sf_dir), "target", n_features=HISTORY)
