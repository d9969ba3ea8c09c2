"""ML read-outs against formulas, landing through a URL, hot-key fragments."""
import json
import math
import os

import pytest
from pyspark.sql import functions as F

from quarry.ml import models as ml
from quarry.operators import windows
from quarry.sources import poll


def _linear(spark, n=400):
    rows = [(float(i), float(i % 7), 3.0 + 2.0 * i - 0.5 * (i % 7) + ((i * 37) % 11) / 10.0) for i in range(n)]
    return spark.createDataFrame(rows, "a double, b double, y double")


def test_scaled_and_raw_ols_predict_the_same(spark):
    data = ml.assembler(["a", "b"]).transform(_linear(spark))
    raw = ml.ols("Features", "y").fit(data).transform(data)
    sc = ml.scaler().fit(data)
    scaled = ml.ols("scaledFeatures", "y").fit(sc.transform(data)).transform(sc.transform(data))
    a = {r.a: r.prediction for r in raw.select("a", "prediction").collect()}
    b = {r.a: r.prediction for r in scaled.select("a", "prediction").collect()}
    assert all(math.isclose(a[k], b[k], rel_tol=1e-9, abs_tol=1e-9) for k in a)


def test_metrics_match_summary(spark):
    data = ml.assembler(["a", "b"]).transform(_linear(spark))
    model = ml.ols("Features", "y").fit(data)
    m = ml.regression_metrics(model.transform(data), "y", n_features=2).first()
    s = model.summary
    assert m.mse == pytest.approx(s.meanSquaredError, rel=1e-9)
    assert m.r2 == pytest.approx(s.r2, rel=1e-9)
    assert m.r2adj == pytest.approx(s.r2adj, rel=1e-9)
    assert ml.evaluator_r2(model.transform(data), "y") == pytest.approx(s.r2, rel=1e-9)


def test_gamma_glm_deviance_formula(spark):
    rows = [(float(x), 1.0 / (0.5 + 0.1 * x) * (1 + ((x * 13) % 5 - 2) / 20.0)) for x in range(1, 200)]
    df = ml.assembler(["x"]).transform(spark.createDataFrame(rows, "x double, y double"))
    model = ml.gamma_glm("Features", "y").fit(df)
    out = ml.glm_summary(spark, model, df, ["x"])
    got = {r.term: r.value for r in out.collect()}
    mu = model.transform(df).select("y", "prediction").collect()
    dev = sum(2 * (-math.log(r.y / r.prediction) + (r.y - r.prediction) / r.prediction) for r in mu)
    assert got["deviance"] == pytest.approx(dev, rel=1e-6)
    pearson = sum(((r.y - r.prediction) / r.prediction) ** 2 for r in mu) / (len(mu) - 2)
    assert got["dispersion"] == pytest.approx(pearson, rel=1e-6)


def test_a_null_feature_raises_unless_asked_for(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    with pytest.raises(Exception):
        ml.assembler(["x"]).transform(df).collect()
    assert ml.assembler(["x"], handle_invalid="skip").transform(df).count() == 2
    assert ml.assembler(["x"], handle_invalid="keep").transform(df).count() == 3


def test_splits(spark):
    df = spark.range(1001).withColumn("t", F.timestamp_seconds("id"))
    train, test = ml.hash_split(df, "id")
    assert train.count() + test.count() == 1001 and 150 < test.count() < 250
    again, _ = ml.hash_split(df.repartition(7), "id")
    assert again.exceptAll(train).count() == 0
    for col in ("id", "t"):
        train, test = ml.time_split(df, col)
        assert (train.agg(F.max("id")).first()[0], test.agg(F.min("id")).first()[0]) == (800, 801)


def test_holdout_scores(spark):
    """Every score from the predictions of its own model on held-out rows."""
    from conftest import SF_ORACLE
    from quarry.plans import learning
    got = {r.model: r for r in learning.holdout_metrics(spark, SF_ORACLE).collect()}
    assert set(got) == {"raw", "scaled", "pipeline", "forest", "telemetry"}
    preds = {**dict(learning._elastic_nets(spark, SF_ORACLE)), "forest": learning._forest(spark, SF_ORACLE)}
    for name, pred in preds.items():
        rows = pred.select("Close", "prediction").collect()
        n, mean = len(rows), sum(r.Close for r in rows) / len(rows)
        sse = sum((r.Close - r.prediction) ** 2 for r in rows)
        r2 = 1 - sse / sum((r.Close - mean) ** 2 for r in rows)
        assert got[name].n == n and got[name].mse == pytest.approx(sse / n)
        assert got[name].r2 == pytest.approx(r2)
        assert got[name].r2adj == pytest.approx(1 - (1 - r2) * (n - 1) / (n - 4))
    assert got["forest"].r2 > 0.5


def test_gamma_regression_of_prices(spark):
    from conftest import SF_ORACLE
    from quarry.plans import learning
    got = {r.term: r.value for r in learning.glm_gamma(spark, SF_ORACLE).collect()}
    assert {"Open", "High", "Low", "intercept", "deviance", "dispersion"} == set(got)
    # prices are near 1/intercept, and rise with the key
    assert 0 < got["intercept"] < 0.01 and got["High"] < 0 < got["dispersion"]


def test_autoregression_against_least_squares(spark):
    import numpy as np
    from conftest import SF_ORACLE
    from quarry.plans import learning
    pred = learning._forecast(spark, SF_ORACLE, history=3)
    rows = pred.select("history", "target", "prediction", "ts").collect()
    ev = spark.read.parquet(f"{SF_ORACLE}/events.parquet").select("user_id", "ts", "event_id", "value").collect()
    cut = min(r.ts for r in rows)
    by_user, x, y = {}, [], []
    for r in sorted(ev, key=lambda r: (r.ts, r.event_id)):
        past = by_user.setdefault(r.user_id, [])
        if len(past) >= 3 and r.ts < cut:
            x.append([*past[-3:], 1.0])
            y.append(r.value)
        past.append(r.value)
    w = np.linalg.lstsq(np.array(x), np.array(y), rcond=None)[0]
    for r in rows[:200]:
        assert r.prediction == pytest.approx(float(np.dot([*r.history, 1.0], w)), rel=1e-6)


def test_land_payload_from_url(spark, scratch):
    src = os.path.join(scratch, "payload.json")
    with open(src, "w") as fh:
        fh.write(json.dumps([{"2024-01-01T00:00:05": 7}, {"2024-01-01T00:00:04": 0}]))
    land = os.path.join(scratch, "landed")
    assert poll.land_payload("file://" + src, land, 0, 1) == 2
    assert poll.land_payload("file://" + src, land, 1, 3) == 2
    rows = poll.datapoints(spark, land).orderBy("index").collect()
    assert [(r.value, r["index"]) for r in rows] == [(7, 1), (0, 2), (7, 3), (0, 4)]


def test_hot_key_is_cut_into_bounded_fragments(spark):
    # one key holds about a third of all rows
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 100).cast("string")).alias("key"),
        F.col("id").alias("t"), F.col("id").cast("double").alias("v"))
    fr = windows.with_fragments(df, ["key"], ["t"], rows_per_fragment=100)
    sizes = fr.groupBy("key", "_frag").count()
    hot = sizes.where("key = 'hot'").collect()
    assert 10 <= len(hot) <= 12 and max(r["count"] for r in hot) <= 100
    assert sizes.agg(F.max("count")).first()[0] <= 100
    # and the result is still the plain window's
    got = windows.lag_list(df, ["key"], ["t"], "v", 5, "lag", rows_per_fragment=100)
    hot_rows = {r.t: r.lag for r in got.where("key = 'hot'").collect()}
    assert hot_rows[303] == [288.0, 291.0, 294.0, 297.0, 300.0]


def test_fragment_paths_on_real_table_by_category(spark):
    """5 categories, ~2,000 rows each at sf0.01: forced into fragments of 300."""
    from pyspark.sql import Window
    from conftest import SF_ORACLE
    ev = spark.read.parquet(f"{SF_ORACLE}/events.parquet").select("event_type", "ts", "event_id", "value")
    got = windows.lag_list(ev, ["event_type"], ["ts", "event_id"], "value", 10, "lag", rows_per_fragment=300)
    ref = ev.withColumn("lag", F.collect_list("value").over(
        Window.partitionBy("event_type").orderBy("ts", "event_id").rowsBetween(-10, -1)))
    assert got.select("event_id", "lag").exceptAll(ref.select("event_id", "lag")).count() == 0
    assert got.count() == ref.count()
    day = ev.withColumn("day", F.to_date("ts"))
    ra = windows.running_average(day, ["event_type"], "day", "value", "ra", rows_per_fragment=4)
    rr = day.withColumn("ra", F.avg("value").over(Window.partitionBy("event_type").orderBy("day")))
    a = ra.select("event_id", F.round("ra", 9).alias("ra"))
    b = rr.select("event_id", F.round("ra", 9).alias("ra"))
    assert a.exceptAll(b).count() == 0 and a.count() == b.count()


def _series_cases(spark):
    schema = "key string, t long, id long, v double"
    rows = [(f"k{i % 3}", None if i % 7 == 0 else i // 2, i, None if i % 9 == 0 else float(i % 13))
            for i in range(300)]
    hot = [("a", 5 if i > 10 else 6, i, float(i)) for i in range(2000)]
    bursts = [("a", i if i < 100 else 1000 + (i // 50 if i < 900 else 18), i, float(i)) for i in range(1800)]
    text = [(k, None if t is None else f"s{t:05d}", i, v) for k, t, i, v in rows]
    return {
        "null order values": (spark.createDataFrame(rows, schema), ["t", "id"], 25),
        "fragments shorter than the list": (spark.createDataFrame(rows, schema), ["t", "id"], 3),
        "text order": (spark.createDataFrame(text, "key string, t string, id long, v double"), ["t"], 25),
        "text tie column": (spark.createDataFrame(rows, schema).withColumn("s", F.col("id").cast("string")),
                            ["t", "s"], 25),
        "two stamps, one hot": (spark.createDataFrame(hot, schema), ["t", "id"], 100),
        "burst in a burst": (spark.createDataFrame(bursts, schema), ["t", "id"], 100),
        "one stamp without a tie column": (spark.createDataFrame(hot, schema).withColumn("t", F.lit(1)), ["t"], 100),
        "null keys": (spark.createDataFrame([(None if i % 2 else "x", i, i, 1.0 * i) for i in range(300)], schema),
                      ["t"], 20),
        "no rows": (spark.createDataFrame([], schema), ["t"], 20),
        "array keys": (spark.createDataFrame(rows, schema).withColumn("key", F.array("key", F.lit("b"))),
                       ["t", "id"], 25),
    }


@pytest.mark.parametrize("name", ["null order values", "fragments shorter than the list", "text order",
                                  "text tie column", "two stamps, one hot", "burst in a burst",
                                  "one stamp without a tie column", "null keys", "no rows", "array keys"])
def test_fragments_equal_the_plain_window(spark, name):
    from pyspark.sql import Window
    df, order, limit = _series_cases(spark)[name]
    tied = df.withColumn("_tie", F.xxhash64(*df.columns))
    sizes = windows.with_fragments(tied, ["key"], [*order, "_tie"], limit).groupBy("_frag").count()
    assert (sizes.agg(F.max("count")).first()[0] or 0) <= limit
    by = Window.partitionBy("key").orderBy(*[F.col(c).asc_nulls_first() for c in [*order, "_tie"]])
    want = tied.withColumn("lag", F.collect_list("v").over(by.rowsBetween(-10, -1))).drop("_tie")
    got = windows.lag_list(df, ["key"], order, "v", 10, "lag", limit)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    ra = windows.running_average(df, ["key"], order[0], "v", "ra", limit)
    want = df.withColumn("ra", F.avg("v").over(Window.partitionBy("key").orderBy(F.col(order[0]).asc_nulls_first())))
    assert (sorted(str((r.id, r.ra and round(r.ra, 9))) for r in ra.collect())
            == sorted(str((r.id, r.ra and round(r.ra, 9))) for r in want.collect()))


def test_sampled_cuts(spark, monkeypatch):
    monkeypatch.setattr(windows, "EXACT_ROWS", 0)
    df = spark.range(20_000).select(F.lit("hot").alias("key"), (F.col("id") * 7 % 20_000).alias("t"),
                                    F.col("id").cast("double").alias("v"))
    sizes = windows.with_fragments(df, ["key"], ["t"], 2000).groupBy("_frag").count().collect()
    assert len(sizes) >= 10 and max(r["count"] for r in sizes) <= 2000
    got = {r.t: len(r.lag) for r in windows.lag_list(df, ["key"], ["t"], "v", 10, "lag", 2000).collect()}
    assert all(got[t] == min(t, 10) for t in got)


def test_wide_keys_are_not_broadcast_by_force(spark):
    df = spark.range(2000).select(F.array_repeat((F.col("id") % 7).cast("string"), 500).alias("k"),
                                  F.col("id").cast("double").alias("v"))
    plan = windows.partition_aggregate(df, ["k"], F.sum("v").alias("total"))._jdf.queryExecution().toString()
    assert "rightHint" not in plan and "BroadcastHashJoin" not in plan.split("== Physical Plan ==")[1]
