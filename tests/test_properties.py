"""Property tests (hypothesis): merge independence, split laws, list lengths."""
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions.harmonic import harmonic_mean
from quarry.ml import models as ml
from quarry.operators import windows

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=1000), min_size=1, max_size=60),
       st.integers(min_value=1, max_value=7))
def test_harmonic_mean_independent_of_partitioning(spark, values, parts):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    a = df.agg(harmonic_mean("v").alias("h")).first().h
    b = df.repartition(parts).agg(harmonic_mean("v").alias("h")).first().h
    if 0 in values:
        assert a == 0.0 and b == 0.0
    else:
        expect = len(values) / sum(1.0 / v for v in values)
        assert math.isclose(a, expect, rel_tol=1e-9) and math.isclose(b, expect, rel_tol=1e-9)


@SETTINGS
@given(st.integers(min_value=1, max_value=500), st.integers(min_value=1, max_value=99))
def test_hash_split_disjoint_and_complete(spark, n, pct):
    df = spark.range(n).withColumnRenamed("id", "k")
    tr, te = ml.hash_split(df, "k", pct)
    a = {r.k for r in tr.collect()}
    b = {r.k for r in te.collect()}
    assert not (a & b) and (a | b) == set(range(n))


@SETTINGS
@given(st.integers(min_value=1, max_value=40), st.integers(min_value=1, max_value=12),
       st.integers(min_value=1, max_value=9))
def test_lag_list_length(spark, n, k, frag):
    df = spark.range(n).select(F.lit("s").alias("key"), F.col("id").alias("t"), F.col("id").cast("double").alias("v"))
    out = windows.lag_list(df, ["key"], ["t"], "v", k, "lag", rows_per_fragment=frag).collect()
    for r in out:
        assert len(r.lag) == min(k, r.t)
        assert r.lag == [float(x) for x in range(max(0, r.t - k), r.t)]


def test_random_split_complete(spark):
    df = spark.range(1000)
    tr, te = ml.random_split(df)
    assert tr.count() + te.count() == 1000
    assert tr.join(te, "id").count() == 0
