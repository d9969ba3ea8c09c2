"""Full-feature models, models on streams, the recurrent network, late rows: values by hand."""
import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from oracle_compare import compare, duck
from quarry.ml import models as ml
from quarry.ml import recurrent
from quarry.plans import all_oracles, all_queries, learning
from quarry.plans.documents import prices
from quarry.streaming import late


@pytest.mark.parametrize("name", ["glm_gamma_single", "ml_stream_predict", "stream_late_table"])
def test_queries(spark, name):
    assert compare(all_queries()[name](spark, SF_ORACLE), duck(SF_ORACLE), all_oracles()[name]) == []


def _design(spark):
    rows = ml.hash_split(prices(spark, SF_ORACLE), "Date")
    return [np.array([[r.Open, r.High, r.Low, r.Close] for r in part.collect()], float) for part in rows]


def _elastic_net(x, y, reg=ml.ELASTIC_NET_REG, mix=ml.ELASTIC_NET_MIX, rounds=5000):
    """Coordinate descent on standardised features and label."""
    n = len(y)
    mean, std, ym, ys = x.mean(0), x.std(0, ddof=1), y.mean(), y.std(ddof=1)
    z, t = (x - mean) / std, (y - ym) / ys
    beta, reg = np.zeros(x.shape[1]), reg / ys
    for _ in range(rounds):
        for j in range(len(beta)):
            r = z[:, j] @ (t - z @ beta + z[:, j] * beta[j]) / n
            beta[j] = np.sign(r) * max(abs(r) - reg * mix, 0) / (z[:, j] @ z[:, j] / n + reg * (1 - mix))
    slopes = beta * ys / std
    return slopes, ym - slopes @ mean


def test_elastic_net_of_three_features(spark):
    train, test = _design(spark)
    slopes, intercept = _elastic_net(train[:, :3], train[:, 3])
    got = {(r.features, r.term): r.value for r in learning.elastic_net_coefficients(spark, SF_ORACLE).collect()}
    std = train[:, :3].std(0, ddof=1)
    scale = np.abs(slopes * std).max()
    for j, name in enumerate(learning.FEATURES):
        assert got["raw", name] * std[j] == pytest.approx(slopes[j] * std[j], abs=0.02 * scale)
        assert got["scaled", name] == pytest.approx(slopes[j] * std[j], abs=0.02 * scale)
    assert got["raw", "intercept"] == pytest.approx(intercept, rel=0.01)
    predicted = [r.prediction for r in learning.pipeline_predictions(spark, SF_ORACLE).orderBy("Date").collect()]
    rows = ml.hash_split(prices(spark, SF_ORACLE), "Date")[1].orderBy("Date").collect()
    want = [intercept + slopes @ [r.Open, r.High, r.Low] for r in rows]
    assert predicted == pytest.approx(want, abs=0.02 * scale * 3)


def test_telemetry_on_both_features(spark):
    train, test = (np.array([[r.Timestamp, r.IntegerValue, r.FloatValue] for r in part.orderBy("Name").collect()], float)
                   for part in learning._telemetry(spark, SF_ORACLE))
    slopes, intercept = _elastic_net(train[:, :2], train[:, 2], rounds=300)
    got = [r.prediction for r in learning.telemetry_predictions(spark, SF_ORACLE).orderBy("Name").collect()]
    assert got == pytest.approx((intercept + test[:, :2] @ slopes).tolist(), abs=0.5)


def test_predictions_are_values_that_fit(spark):
    rows = learning.rf_regression(spark, SF_ORACLE).collect()
    error = np.array([r.prediction - r.Close for r in rows])
    close = np.array([r.Close for r in rows])
    assert len({r.prediction for r in rows}) > 10 and error.var() < close.var()
    metrics = {r.model: r for r in learning.holdout_metrics(spark, SF_ORACLE).collect()}
    assert metrics["forest"].mse == pytest.approx(float((error ** 2).mean()), rel=1e-3)


def test_gradient_by_differences():
    rng = np.random.default_rng(2)
    x, y, w = rng.normal(size=(6, 5)), rng.normal(size=6), recurrent.start(3) + rng.normal(0, 0.3, 3 * 3 + 3 * 3 + 1)
    _, grad = recurrent.loss_and_gradient(x, y, w, 3)
    for i in range(len(w)):
        step = np.zeros(len(w))
        step[i] = 1e-6
        up, down = (recurrent.loss_and_gradient(x, y, w + s * step, 3)[0] for s in (1, -1))
        assert grad[i] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_recurrent_network_learns_what_no_line_can(spark):
    rng = np.random.default_rng(4)
    series = [0.3]
    for _ in range(1500):                                    # a noisy logistic map: the next value is no line
        series.append(float(np.clip(3.8 * series[-1] * (1 - series[-1]) + rng.normal(0, 0.005), 0, 1)))
    rows = [(series[i:i + 6], series[i + 6]) for i in range(len(series) - 6)] + [([0.1, None, 0.2, 0.3, 0.1, 0.2], 0.5), ([0.1] * 6, None)]
    df = spark.createDataFrame(rows, "history array<double>, target double").repartition(4).cache()
    model = recurrent.fit(df, steps=80, rate=0.05)
    one = recurrent.fit(df.coalesce(1), steps=3)
    assert model.losses[-1] < 0.3 * model.losses[0] and one.losses == pytest.approx(model.losses[:3])
    scored = model.transform(df).collect()
    assert sum(r.prediction is None for r in scored) == 1
    mse = np.mean([(r.prediction - r.target) ** 2 for r in scored if r.prediction is not None and r.target is not None])
    line = ml.ols("Features", "target").fit(ml.sequences_to_vectors(df.where("target is not null and not exists(history, x -> x is null)")))
    assert mse < 0.6 * line.summary.meanSquaredError


def test_rnn_forecast_of_held_out_time(spark):
    rows = learning.rnn_forecast(spark, SF_ORACLE).collect()
    target = np.array([r.target for r in rows])
    mse = np.mean((np.array([r.prediction for r in rows]) - target) ** 2)
    linear = learning.forecast_metrics(spark, SF_ORACLE).first()
    assert mse < 1.1 * target.var() and mse < 1.5 * linear.mse


def test_late_and_kept_rows_are_the_input_after_a_restart(spark, scratch):
    src, location = os.path.join(scratch, "in"), os.path.join(scratch, "q")
    base = dt.datetime(2024, 1, 1, 10)

    def put(*minutes):
        rows = [(base + dt.timedelta(minutes=m) if m is not None else None, m) for m in minutes]
        spark.createDataFrame(rows, "ts timestamp, m int").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("ts timestamp, m int").parquet(src)
        return late.divide(stream, "late", "ts", "10 minutes", "5 minutes", location)

    put(0, 31)
    put(1, 29)                                               # the clock of the batch before the last one counts
    found = put(2, 19, 20, 31, None)
    assert sorted(r.m for r in found.late().collect() if r.m is not None) == [2, 19]
    assert sorted(r.m for r in found.kept().collect()) == [0, 1, 20, 29, 31, 31]
    assert found.late().where("ts is null").count() == 1
