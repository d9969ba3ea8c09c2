"""Hand-made edge cases for the batch operators."""
import json
import math
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions.harmonic import harmonic_mean
from quarry.operators import nested, windows
from quarry.operators.aggregates import harmonic, ordered_concat
from quarry.sources import readers, schemas


def _hm(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return df.agg(harmonic_mean("v").alias("h")).first()["h"]


def test_harmonic_mean_cases(spark):
    assert _hm(spark, [1.0, 2.0, 4.0]) == pytest.approx(3 / 1.75)
    assert _hm(spark, [1.0, 0.0]) == 0.0
    assert _hm(spark, [2.0, -2.0]) == math.inf
    assert math.isnan(_hm(spark, []))
    assert _hm(spark, [None, 2.0, 2.0]) == 2.0


def test_harmonic_grouped_matches_python(spark):
    rows = [("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", 0.0), ("c", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.val_harmonicmean for r in harmonic(df, "v", ["k"]).collect()}
    assert got["a"] == pytest.approx(2 / (1 + 1 / 3))
    assert got["b"] == 0.0
    assert math.isnan(got["c"])


def test_na_drop_null_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan"))], "id int, v double")
    assert [r.id for r in nested.na_drop(df, ["v"]).collect()] == [1]


def test_explode_skips_null_and_empty(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "id int, a array<int>")
    out = df.select("id", F.explode("a").alias("x")).collect()
    assert sorted((r.id, r.x) for r in out) == [(1, 1), (1, 2)]


DOC = {
    "title": "t", "description": "d", "link": "l",
    "events": [
        {"id": "E1", "title": "x", "description": "y", "link": "z", "closed": None,
         "categories": [{"id": "c1", "title": "C1"}], "sources": [{"id": "s", "url": "u"}],
         "geometry": [
             {"coordinates": [1.5, 2.5], "date": "2021-05-01T06:00:00Z", "magnitudeUnit": "u",
              "magnitudeValue": 3.0, "type": "Point"},
             {"coordinates": [[[1.0, 2.0], [3.0, 4.0]]], "date": "2021-05-02T00:00:00Z",
              "magnitudeUnit": "u", "magnitudeValue": None, "type": "Polygon"}]},
        {"id": "E2", "title": "x", "description": "y", "link": "z", "closed": None,
         "categories": [], "sources": [], "geometry": []},
    ],
}


@pytest.fixture()
def doc_path(scratch):
    p = os.path.join(scratch, "doc.json")
    with open(p, "w") as fh:
        json.dump(DOC, fh, indent=2)
    return p


def test_schema_forms_read_the_document(spark, doc_path):
    for form in ("infer", "structtype", "ddl", "dataclass"):
        docs = readers.read_event_docs(spark, doc_path, form)
        rows = nested.explode_nested(docs).select("event.id", "geometry.magnitudeValue").collect()
        assert sorted(r.id for r in rows) == ["E1", "E1"], form   # E2 has no geometry


def test_date_field_truncates_and_coordinates_types(spark, doc_path):
    docs = readers.read_event_docs(spark, doc_path, "structtype")
    rows = nested.explode_nested(docs).select("geometry.date", "geometry.coordinates").collect()
    assert str(rows[0].date) == "2021-05-01"
    # as strings, polygon coordinates keep their raw JSON text
    assert rows[1].coordinates is not None
    dc = readers.read_event_docs(spark, doc_path, "dataclass")
    drows = nested.explode_nested(dc).select("geometry.coordinates", "geometry.type").collect()
    by_type = {r.type: r.coordinates for r in drows}
    assert by_type["Point"] == [1.5, 2.5]
    assert by_type["Polygon"] is None       # row survives, field is NULL


def test_schema_of_dataclass():
    s = schemas.schema_of(schemas.EventsAgg)
    ev = s["events"].dataType.elementType
    assert "description" not in ev.fieldNames()
    geo = ev["geometry"].dataType.elementType
    assert geo["magnitudeValue"].dataType.typeName() == "float"
    assert geo["coordinates"].dataType.elementType.typeName() == "double"
    assert all(f.nullable for f in s.fields)


def test_flagship_measurements_drop_nulls(spark, doc_path):
    m = nested.event_measurements(readers.read_event_docs(spark, doc_path)).collect()
    assert [(r.event, r.magnitudeValue) for r in m] == [("E1", 3.0)]


def _series(spark, n_keys=3, n=40, nulls=True, ties=True):
    import random
    rnd = random.Random(7)
    rows = []
    for k in range(n_keys):
        for i in range(n * (k + 1)):
            t = (i // 2) if ties else i
            v = None if (nulls and rnd.random() < 0.1) else float(rnd.randint(0, 50))
            rows.append((f"k{k}", t, i, v))
    return spark.createDataFrame(rows, "key string, t long, id long, v double")


@pytest.mark.parametrize("frag", [3, 7, 1000])
def test_running_average_matches_window(spark, frag):
    df = _series(spark)
    got = windows.running_average(df, ["key"], "t", "v", "ra", rows_per_fragment=frag)
    ref = df.withColumn("ra", F.avg("v").over(Window.partitionBy("key").orderBy("t")))
    a = sorted((r.id, None if r.ra is None else round(r.ra, 9)) for r in got.select("id", "ra").collect())
    b = sorted((r.id, None if r.ra is None else round(r.ra, 9)) for r in ref.select("id", "ra").collect())
    assert a == b


@pytest.mark.parametrize("frag,k", [(3, 10), (5, 2), (11, 4), (1000, 10)])
def test_lag_list_matches_window(spark, frag, k):
    df = _series(spark, ties=False)
    got = windows.lag_list(df, ["key"], ["t", "id"], "v", k, "lag", rows_per_fragment=frag)
    ref = df.withColumn("lag", F.collect_list("v").over(
        Window.partitionBy("key").orderBy("t", "id").rowsBetween(-k, -1)))
    a = sorted((r.id, tuple(r.lag)) for r in got.select("id", "lag").collect())
    b = sorted((r.id, tuple(r.lag)) for r in ref.select("id", "lag").collect())
    assert a == b


def test_lag_list_skips_nulls(spark):
    df = spark.createDataFrame([("s", 1, 1.0), ("s", 2, 2.0), ("s", 3, None), ("s", 4, 4.0)],
                               "key string, t int, v double")
    out = windows.lag_list(df, ["key"], ["t"], "v", 10, "lag").orderBy("t").collect()
    assert [r.lag for r in out] == [[], [1.0], [1.0, 2.0], [1.0, 2.0]]


def test_sequence_windows_keep_null_positions(spark):
    rows = [("s", i, None if i == 3 else float(i)) for i in range(8)]
    df = spark.createDataFrame(rows, "key string, t int, v double")
    out = windows.sequence_windows(df, ["key"], ["t"], "v", 3, rows_per_fragment=2).orderBy("t").collect()
    assert [(r.t, r.history, r.target) for r in out][:2] == [
        (3, [0.0, 1.0, 2.0], None), (4, [1.0, 2.0, None], 4.0)]
    assert len(out) == 5


def test_ordered_concat_is_order_independent(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "t int, s string").repartition(3)
    assert df.agg(ordered_concat(["t"], "s").alias("x")).first().x == "abc"


def test_prune_keeps_only_paths():
    s = schemas.prune(schemas.EVENT_DOC_SCHEMA, ["events.id", "events.geometry.date"])
    assert s.simpleString() == "struct<events:array<struct<geometry:array<struct<date:date>>,id:string>>>"
    with pytest.raises(ValueError):
        schemas.prune(schemas.EVENT_DOC_SCHEMA, ["events.nope"])


def test_narrow_schema_reads_same_values(spark, doc_path):
    narrow = schemas.prune(schemas.EVENT_DOC_SCHEMA, ["events.id", "events.categories.id",
                                                      "events.geometry.date", "events.geometry.magnitudeValue"])
    a = nested.event_measurements(readers.read_json(spark, doc_path, narrow)).collect()
    b = nested.event_measurements(readers.read_event_docs(spark, doc_path)).collect()
    assert [(r.event, r.date, r.magnitudeValue) for r in a] == [(r.event, r.date, r.magnitudeValue) for r in b]


def test_pane_concat_equals_direct(spark):
    import datetime as dt
    from quarry.operators import timewindows
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(seconds=s, microseconds=u), f"l{s}-{u}") for s in (0, 1, 4, 4, 17, 40) for u in (0, 5)]
    df = spark.createDataFrame(rows, "arrival timestamp, line string")
    panes = timewindows.window_concat(df, "arrival", "line", "15 seconds", "3 seconds")
    # the one-step form, written out
    direct = df.groupBy(F.window("arrival", "15 seconds", "3 seconds").alias("window")).agg(
        ordered_concat(["arrival"], "line").alias("text"), F.count(F.lit(1)).alias("n_lines"))
    a = sorted((r.window.start, r.text, r.n_lines) for r in panes.collect())
    b = sorted((r.window.start, r.text, r.n_lines) for r in direct.collect())
    assert a == b and len(a) > 5


def test_concat_orders_by_time_first(spark):
    """One order in every form: time, then the order columns."""
    import datetime as dt
    from quarry.operators import timewindows
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(seconds=s), 100 - s, f"l{s},") for s in range(0, 12, 2)] + [(base, 1, "first,")]
    df = spark.createDataFrame(rows, "arrival timestamp, n int, line string")
    joined = timewindows.window_concat(df, "arrival", "line", "12 seconds", "3 seconds", order_cols=["n"])
    # a slide that does not divide the duration takes the one-step form
    direct = timewindows.window_concat(df, "arrival", "line", "12 seconds", "5 seconds", order_cols=["n"])
    want = "first,l0,l2,l4,l6,l8,l10,"
    assert want in [r.text for r in joined.collect()] and want in [r.text for r in direct.collect()]


def test_inputs_of_the_same_name_stay_apart(spark, scratch):
    import os
    from quarry.sources import fixtures
    rows = {}
    for name, n in (("a", 3), ("b", 5)):
        folder = os.path.join(scratch, name, "sf")
        spark.read.parquet("/root/testdata/sf0.001/part.parquet").limit(n).coalesce(1).write.parquet(
            os.path.join(folder, "part.parquet"))
        rows[name] = folder
    count = lambda f: spark.read.option("header", True).csv(fixtures.prices_csv(spark, f)).count()
    assert [count(rows["a"]), count(rows["b"]), count(rows["a"])] == [3, 5, 3]


def test_no_checkpoint_folder_on_a_cluster(monkeypatch):
    from quarry import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session._checkpoint_root(Session())


def test_written_tables_are_removed(spark):
    import os
    from quarry import session
    table = session.write_table(spark.range(3), "small")
    assert table.count() == 3
    path, _ = session._TABLES[-1]
    session.remove_tables()
    assert not os.path.exists(path)


def test_scalar_function_and_udf_agree(spark):
    from quarry.functions import udfs
    udfs.register_all(spark)
    rows = spark.sql("SELECT log_magnitude(v) a, log_magnitude_udf(v) b FROM VALUES (0D), (9D), (0.5D), (NULL) t(v)").collect()
    assert rows[3].a is None and all(r.a == pytest.approx(r.b) for r in rows[:3])
