"""User-defined aggregates in two phases: batch, hot keys, streams and their restart."""
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle_compare import compare, duck
from quarry.operators import twophase
from quarry.plans import all_oracles, all_queries
from quarry.streaming import runner

SF = "/root/testdata/sf0.01"
SPREAD = twophase.Aggregator(                                # largest distance of two values
    zero=(None, None), reduce=lambda b, v: SPREAD.merge(b, (float(v.min()), float(v.max()))),
    merge=lambda a, b: b if a[0] is None else a if b[0] is None else (min(a[0], b[0]), max(a[1], b[1])),
    finish=lambda b: None if b[0] is None else b[1] - b[0], buffer="low DOUBLE, high DOUBLE", result="DOUBLE")


@pytest.mark.parametrize("name", ["udaf_two_phase", "stream_udaf_state"])
def test_queries(spark, name):
    assert compare(all_queries()[name](spark, SF), duck(SF), all_oracles()[name]) == []


def test_null_keys_null_values_and_arrays(spark, monkeypatch):
    rows = [(k, [k or "x"], v) for k in ("a", "b", None) for v in (1.0, None, 5.0, -2.0)] + [("c", ["c"], None)]
    df = spark.createDataFrame(rows, "k string, ks array<string>, v double").repartition(5)
    for keys in (["k"], ["ks", "k"]):
        got = {r.k: r.s for r in twophase.aggregate(df, keys, "v", SPREAD, "s").collect()}
        assert got == {"a": 7.0, "b": 7.0, None: 7.0, "c": None}
    assert [r.s for r in twophase.aggregate(df, [], "v", SPREAD, "s").collect()] == [7.0]
    none = df.where("v > 100")
    assert twophase.aggregate(none, ["k"], "v", SPREAD, "s").count() == 0
    assert [math.isnan(r.hm) for r in twophase.aggregate(none, [], "v", twophase.HARMONIC_MEAN, "hm").collect()] == [True]


def test_a_hot_key_arrives_as_one_partial_per_task(spark):
    df = spark.range(0, 60_000, 1, 12).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50).alias("k"),
                                               (F.col("id") % 97 + 1).cast("double").alias("v"))
    parts = twophase.partials(df, ["k"], "v", twophase.HARMONIC_MEAN)
    assert parts.where("k = 7").count() == 12
    got = {r.k: r.hm for r in twophase.aggregate(df, ["k"], "v", twophase.HARMONIC_MEAN, "hm").collect()}
    plain = df.groupBy("k").agg((F.count("*") / F.sum(1 / F.col("v"))).alias("hm")).collect()
    assert got == pytest.approx({r.k: r.hm for r in plain})


def test_zeros_and_merging():
    agg = twophase.HARMONIC_MEAN
    assert agg.finish(agg.reduce(agg.zero, np.array([0.0, 4.0]))) == 0.0
    assert agg.finish(agg.merge(agg.reduce(agg.zero, np.array([1.0, 2.0])), agg.reduce(agg.zero, np.array([4.0])))) == pytest.approx(12 / 7)
    assert agg.finish(agg.reduce(agg.zero, np.array([1.0, -1.0]))) == float("inf")


def test_state_survives_a_restart(spark, scratch):
    runner.use_rocksdb_state(spark)
    src, location = os.path.join(scratch, "in"), os.path.join(scratch, "q")

    def put(rows):
        spark.createDataFrame(rows, "k string, v double").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("k string, v double").option("maxFilesPerTrigger", 1).parquet(src)
        agg = twophase.aggregate_stream(stream, ["k"], "v", twophase.HARMONIC_MEAN, "hm")
        result = runner.run(agg, "restart", "update", keys=["k"], location=location, state_partitions=2)
        return {r.k: r.hm for r in result.table().collect()}

    assert put([("a", 1.0), ("b", 2.0), (None, 8.0)]) == {"a": 1.0, "b": 2.0, None: 8.0}
    got = put([("a", 2.0), ("a", 4.0), (None, None)])
    assert got == {"a": pytest.approx(12 / 7), "b": 2.0, None: 8.0}
