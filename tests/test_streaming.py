"""Streaming semantics: late rows per output mode, source restart."""
import datetime as dt
import json
import os

import pytest

from pyspark.sql import functions as F

from quarry.sources import poll
from quarry.streaming import events as sev
from quarry.streaming import runner

SCHEMA = "ts timestamp, value double"


def _write_batches(spark, d):
    # start, advance, filler, late, advance (one file per micro-batch)
    stamps = ["10:00:00", "10:10:00", "10:10:30", "10:05:00", "10:20:00"]
    for i, s in enumerate(stamps):
        t = dt.datetime.fromisoformat(f"2024-01-01T{s}")
        spark.createDataFrame([(t, float(i + 1))], SCHEMA).coalesce(1) \
            .write.mode("overwrite").parquet(os.path.join(d, f"b{i}"))
    return [os.path.join(d, f"b{i}") for i in range(len(stamps))]


def _stream(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    for i, path in enumerate(_write_batches(spark, os.path.join(scratch, "stage"))):
        f = [x for x in os.listdir(path) if x.endswith(".parquet")][0]
        os.link(os.path.join(path, f), os.path.join(src, f"{i:02d}.parquet"))
        os.utime(os.path.join(src, f"{i:02d}.parquet"), (1_000_000 + i, 1_000_000 + i))
    df = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    return sev.windowed_stats(df, "ts", "value", "1 minute", "2 minutes")


def _starts(df):
    return sorted(r.window.start.strftime("%H:%M") for r in df.select("window").collect())


@pytest.mark.parametrize("mode,late_kept", [("complete", True), ("update", False), ("append", False)])
def test_late_rows(spark, scratch, mode, late_kept):
    res = runner.run(_stream(spark, scratch), f"late_{mode}", mode,
                     keys=["window"] if mode == "update" else None)
    starts = _starts(res.table())
    assert ("10:05" in starts) == late_kept
    assert "10:00" in starts and "10:10" in starts


def _land(d, first_payload, n_payloads, first_ts):
    for p in range(first_payload, first_payload + n_payloads):
        base = first_ts + dt.timedelta(seconds=5 * (p - first_payload))
        body = [{(base + dt.timedelta(seconds=4 - j)).strftime("%Y-%m-%dT%H:%M:%S"): p * 10 + j}
                for j in range(5)]
        sub = os.path.join(d, f"file_no={p}")
        os.makedirs(sub)
        with open(os.path.join(sub, "part-0.json"), "w") as fh:
            fh.write(json.dumps({"payload": p, "first_index": p * 5 + 1, "body": json.dumps(body)}) + "\n")


def test_poll_source_restart_exactly_once(spark, scratch):
    land = os.path.join(scratch, "landed")
    out, ckpt = os.path.join(scratch, "out"), os.path.join(scratch, "ckpt")
    _land(land, 0, 2, dt.datetime(2024, 1, 1))

    def once():
        q = (poll.datapoint_stream(spark, land).writeStream.format("parquet")
             .option("path", out).option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start())
        q.awaitTermination(120)

    once()
    _land(land, 2, 1, dt.datetime(2024, 1, 1, 0, 1))
    once()
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 15
    assert sorted(r["index"] for r in rows) == list(range(1, 16))


def test_half_landed_payload_is_not_passed_over(spark, scratch):
    land = os.path.join(scratch, "landed")
    _land(land, 0, 1, dt.datetime(2024, 1, 1))
    os.makedirs(os.path.join(land, "file_no=1"))                 # the folder is there, the file is not
    reader = poll.LandedPayloadStreamReader(land)
    assert reader.latestOffset() == {"file": 0}
    _land(land, 2, 1, dt.datetime(2024, 1, 1, 0, 2))             # lands out of order
    assert reader.latestOffset() == {"file": 0}
    os.rmdir(os.path.join(land, "file_no=1"))
    _land(land, 1, 1, dt.datetime(2024, 1, 1, 0, 1))
    assert reader.latestOffset() == {"file": 2}
    assert [p.file_no for p in reader.partitions({"file": 0}, {"file": 2})] == [1, 2]


def test_landing_renames_the_folder(scratch):
    src, land = os.path.join(scratch, "p.json"), os.path.join(scratch, "landed")
    with open(src, "w") as fh:
        fh.write(json.dumps([{"2024-01-01T00:00:05": 7}]))
    poll.land_payload("file://" + src, land, 0, 1)
    assert os.listdir(land) == ["file_no=0"] and poll._landed_numbers(land) == [0]


@pytest.mark.parametrize("folder,error", [("hdfs://host/landing", ValueError), ("/no/such/folder", FileNotFoundError)])
def test_a_folder_that_cannot_be_read_raises(folder, error):
    with pytest.raises(error):
        poll.LandedPayloadStreamReader(folder).latestOffset()


def test_malformed_payloads_fail_or_are_kept_apart(spark):
    good = json.dumps([{"2024-01-01T00:00:05": 7}])
    bad = ["not json", None, json.dumps({"a": 1}), json.dumps([{"yesterday": 7}]), json.dumps([{"2024-01-01T00:00:05": None}])]
    df = spark.createDataFrame([(i, 10 * i, b) for i, b in enumerate([good, *bad])], poll.LANDED_SCHEMA)
    assert [r["index"] for r in poll.decode_payloads(df, malformed="skip").collect()] == [0]
    assert sorted(r.payload for r in poll.rejected_payloads(df).collect()) == [1, 2, 3, 4, 5]
    for payload in range(1, 6):
        with pytest.raises(Exception, match=f"malformed payload {payload}"):
            poll.decode_payloads(df.where(f"payload = {payload}")).collect()
    assert poll.decode_payloads(df.where("payload = 0")).count() == 1


def test_a_limit_raises_and_leaves_no_result(spark, scratch):
    with pytest.raises(TimeoutError):
        runner.run(_stream(spark, scratch), "limited", "complete", timeout_s=0.01)


def _file(spark, folder, name, rows):
    staged = os.path.join(folder, f".{name}")
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(staged)
    part = [x for x in os.listdir(staged) if x.endswith(".parquet")][0]
    os.rename(os.path.join(staged, part), os.path.join(folder, f"{name}.parquet"))


@pytest.mark.parametrize("mode", ["append", "complete", "update"])
def test_restart_through_the_runner(spark, scratch, monkeypatch, mode):
    """Stop, add files, start again at the same location: each row once."""
    monkeypatch.setattr(runner, "COMPACT_EVERY", 2)
    src, place = os.path.join(scratch, "src"), os.path.join(scratch, "place")
    os.makedirs(src)
    at = dt.datetime(2024, 1, 1)

    def once():
        df = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
        if mode != "append":
            df = sev.windowed_stats(df, "ts", "value", "1 minute", None)
        return runner.run(df, f"again_{mode}", mode, keys=["window"] if mode == "update" else None, location=place)

    for turn in range(3):
        for i in range(3):
            stamp = 3 * turn + i
            _file(spark, src, f"f{stamp}", [(at + dt.timedelta(seconds=20 * stamp), float(stamp))])
        once()
    # read back by a process that has written nothing
    table = runner.StreamResult(spark, place, mode, ["window"]).table()
    if mode == "append":
        assert sorted(r.value for r in table.collect()) == [float(i) for i in range(9)]
    else:
        assert sorted(r.sum_value for r in table.collect()) == [3.0, 12.0, 21.0]
    if mode == "update":
        assert any(n.startswith("snapshot_id=") for n in os.listdir(os.path.join(place, "out")))


def test_pane_state_holds_each_line_once(spark, scratch):
    from quarry.operators import timewindows
    src = os.path.join(scratch, "src")
    rows = [(dt.datetime(2024, 1, 1, 0, 0, i), f"l{i}") for i in range(9)]
    spark.createDataFrame(rows, "arrival timestamp, line string").coalesce(1).write.parquet(src)
    lines = spark.readStream.schema("arrival timestamp, line string").parquet(src)
    res = runner.run(timewindows.panes(lines, "arrival", "line", "3 seconds"), "panes", "update", keys=["pane"])
    assert [p["stateOperators"][0]["numRowsTotal"] for p in res.query.recentProgress if p["numInputRows"]] == [3]
    got = timewindows.join_panes(res.table(), "15 seconds", "3 seconds").orderBy("window").collect()
    assert got[4].text == "".join(f"l{i}" for i in range(9)) and got[0].text == "l0l1l2"


def test_hot_pane_is_held_in_bounded_chunks(spark, scratch):
    """Half of all lines arrive in one pane, over several batches: no value of
    the state holds more than a chunk, panes that are over leave the state, and
    the text is that of one batch over everything."""
    from quarry.operators import timewindows
    base = dt.datetime(2024, 1, 1)
    times = ([base + dt.timedelta(seconds=0.1 * i) for i in range(300)]
             + [base + dt.timedelta(seconds=31, microseconds=i) for i in range(600)]
             + [base + dt.timedelta(seconds=60 + 0.1 * i) for i in range(300)])
    rows = [(t, i, f"l{i},") for i, t in enumerate(times)]
    schema, size = "arrival timestamp, number long, line string", 250
    src = os.path.join(scratch, "src")
    for at in range(0, len(rows), size):         # in the order of arrival
        spark.createDataFrame(rows[at:at + size], schema).coalesce(1).write.mode("append").parquet(src)
    lines = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src).withWatermark("arrival", "5 seconds")
    held = timewindows.panes(lines, "arrival", "line", "3 seconds", number="number", chunk_lines=50)
    res = runner.run(held, "chunks", "update", keys=["pane", "chunk"])
    batches = [p for p in res.query.recentProgress if p["numInputRows"]]
    assert len(batches) == 5
    pieces = res.table()
    assert pieces.agg(F.max("n_lines")).first()[0] == 50
    hot = pieces.where(F.col("pane.start") == base + dt.timedelta(seconds=30))
    assert hot.count() == 12 + (300 % 50 > 0)
    # what the state holds at the end is less than what it has held
    assert res.query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] < pieces.count() // 2
    got = timewindows.join_panes(pieces, "15 seconds", "3 seconds")
    want = timewindows.window_concat(spark.read.schema(schema).parquet(src), "arrival", "line", "15 seconds", "3 seconds")
    assert {(r.window, r.text, r.n_lines) for r in got.collect()} == {(r.window, r.text, r.n_lines) for r in want.collect()}


def test_lines_land_in_order_of_arrival(spark):
    """Numbers follow the arrival without a gap, every slice is later than the
    one before it, and the stream takes a slice to a batch."""
    from quarry.plans import streams
    from quarry.sources import fixtures
    path = fixtures.landed_lines(spark, "/root/testdata/sf0.001")
    rows = spark.read.schema(fixtures.LINES_SCHEMA).json(path).orderBy("number").collect()
    assert [r.number for r in rows] == list(range(len(rows)))
    assert [(r.arrival, r.doc_id, r.line_no) for r in rows] == sorted((r.arrival, r.doc_id, r.line_no) for r in rows)
    assert [r.slice for r in rows] == sorted(r.slice for r in rows)
    res = runner.run(streams.lines_stream(spark, "/root/testdata/sf0.001"), "slices", "append")
    taken = [p["numInputRows"] for p in res.query.recentProgress if p["numInputRows"]]
    sizes = {}
    for r in rows:
        sizes[r.slice] = sizes.get(r.slice, 0) + 1
    assert taken == [sizes[s] for s in sorted(sizes)] and len(taken) == fixtures.LEAST_SLICES


def test_numbered_rows(spark):
    from quarry.operators.ordering import numbered
    df = spark.range(5000).select(F.when(F.col("id") % 7 > 0, (F.col("id") * 7919) % 3001).alias("v"), "id")
    got = numbered(df, [F.col("v").asc_nulls_first(), F.col("id")]).orderBy("number").collect()
    assert [r.number for r in got] == list(range(5000))
    key = [(r.v is not None, r.v or 0, r.id) for r in got]
    assert key == sorted(key)
    assert numbered(df.limit(0), [F.col("id")]).count() == 0


def test_decode_keeps_every_map_entry(spark):
    body = json.dumps([{"2024-01-01T00:00:05": 7, "2024-01-01T00:00:06": 8}, {"2024-01-01T00:00:04": 0}])
    df = spark.createDataFrame([(0, 1, body)], poll.LANDED_SCHEMA)
    rows = poll.decode_payloads(df).orderBy("index").collect()
    assert [(r.value, r["index"]) for r in rows] == [(7, 1), (8, 2), (0, 3)]
    assert rows[0].timestamp == dt.datetime(2024, 1, 1, 0, 0, 5)


def test_file_source_path_bounds_batches(spark, scratch):
    land = os.path.join(scratch, "landed")
    _land(land, 0, 3, dt.datetime(2024, 1, 1))
    df = poll.datapoint_file_stream(spark, land, max_files_per_trigger=1)
    res = runner.run(df, "file_path", "append")
    rows = res.table().collect()
    assert sorted(r["index"] for r in rows) == list(range(1, 16))
    batches = [p for p in res.query.recentProgress if p["numInputRows"] > 0]
    assert len(batches) == 3


def test_processing_time_trigger_and_console(spark, scratch):
    from quarry.streaming import sinks
    src = os.path.join(scratch, "src")
    spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, i), float(i)) for i in range(6)], SCHEMA) \
        .coalesce(1).write.parquet(src)
    df = spark.readStream.schema(SCHEMA).parquet(src)
    res = runner.run(df, "ptime", "append", processing_time="1 second")
    try:
        res.query.processAllAvailable()
    finally:
        res.query.stop()
    assert res.table().count() == 6
    q = sinks.console(sev.windowed_stats(spark.readStream.schema(SCHEMA).parquet(src), "ts", "value",
                                         "1 minute", None), "complete", processing_time=None)
    try:
        q.processAllAvailable()
        assert q.lastProgress["numInputRows"] == 6
    finally:
        q.stop()


def test_replayed_batch_is_idempotent(spark, scratch):
    """A crash after the sink write but before the commit replays the batch;
    overwrite-by-batch-id leaves the output unchanged."""
    from quarry.streaming import sinks
    src, out, ckpt = (os.path.join(scratch, p) for p in ("src", "out", "ckpt"))
    spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, i), float(i)) for i in range(10)], SCHEMA) \
        .coalesce(1).write.parquet(src)

    def start():
        agg = sev.windowed_stats(spark.readStream.schema(SCHEMA).parquet(src), "ts", "value", "5 minutes", None)
        q = (agg.writeStream.outputMode("complete").option("checkpointLocation", ckpt)
             .foreachBatch(sinks.parquet_batches(out)).trigger(availableNow=True).start())
        q.awaitTermination(120)
        return q

    start()
    before = sorted(tuple(r) for r in spark.read.parquet(out).select("batch", "sum_value").collect())
    commits = sorted(int(f) for f in os.listdir(os.path.join(ckpt, "commits")) if f.isdigit())
    last = commits[-1]
    for name in (str(last), f".{last}.crc"):                       # simulate the crash
        path = os.path.join(ckpt, "commits", name)
        if os.path.exists(path):
            os.remove(path)
    q2 = start()
    assert last in [p["batchId"] for p in q2.recentProgress]            # it was replayed
    after = sorted(tuple(r) for r in spark.read.parquet(out).select("batch", "sum_value").collect())
    assert after == before and len(before) == 2
