"""Work that has to follow the input's size: bytes read of whole documents, what
windows and newest rows exchange, files of a micro-batch, tokens of a scan."""
import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F

from quarry.operators import timewindows
from quarry.plans import streams
from quarry.sources import fixtures, readers, splitjson
from quarry.streaming import runner


def _bytes_read(spark):
    stats = spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(s.getBytesRead() for s in stats)


@pytest.mark.parametrize("indent", [None, 2])
def test_whole_documents_are_read_once(spark, tmp_path, indent):
    rows = [{"id": k, "at": [k / 8, k, -1.5e300, 12345678901234567890.5], "odd": "} \n\x1e"} for k in range(4000)]
    text = json.dumps({"events": rows, "title": None}, indent=indent)
    (tmp_path / "a.json").write_text(text)
    (tmp_path / "b.json").write_text('\n [{"title": "x"},\n {"title": 1.50}]\n')
    (tmp_path / "c.json").write_text("")
    schema = "events ARRAY<STRUCT<id: STRING, at: ARRAY<STRING>, odd: STRING>>, title STRING"
    before = _bytes_read(spark)
    got = readers.read_json(spark, str(tmp_path), schema).collect()
    assert _bytes_read(spark) - before < 6 * len(text)
    plain = spark.read.option("multiLine", True).schema(schema).json(str(tmp_path)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, plain)) and len(got) == 3


def test_inferred_documents_equal_the_plain_reader(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": [1, "x", 2.50],\n "b": {"c": 1}}')
    got = readers.read_json(spark, str(tmp_path))
    plain = spark.read.option("multiLine", True).json(str(tmp_path))
    assert got.schema == plain.schema and got.collect() == plain.collect()


def test_files_of_a_micro_batch_follow_the_input():
    assert [streams.files_per_batch(n) for n in (0, 1, 3, 10, 100, 600, 36000)] == [1, 1, 1, 2, 25, 64, 64]


def test_pieces_are_exchanged_once_for_all_their_windows(spark):
    base = dt.datetime(1970, 1, 1) - dt.timedelta(minutes=4)
    rows = [(base + dt.timedelta(seconds=s), f"<{s}>") for s in range(0, 500) if s % 50 < 31]
    pieces = timewindows.panes(spark.createDataFrame(rows, "at timestamp, line string"), "at", "line", "3 seconds")
    joined = timewindows.join_panes(pieces.localCheckpoint(), "15 seconds", "3 seconds")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\((\w+)", plan)) == 1 and "hashpartitioning(_block" in plan
    want = {}
    for at, line in rows:
        last = int((at - dt.datetime(1970, 1, 1)).total_seconds()) // 3 * 3
        for j in range(5):
            want.setdefault(last - 3 * j, []).append(line)
    got = joined.select(F.unix_micros("window.start").alias("a"), F.unix_micros("window.end").alias("b"), "text", "n_lines").collect()
    assert {(r.a, r.b, r.text, r.n_lines) for r in got} == {
        (a * 10**6, (a + 15) * 10**6, "".join(x), len(x)) for a, x in want.items()} and len(got) == len(want)


def test_newest_rows_exchange_keys_only(spark):
    rows = [(k if k else None, n, f"text {k} {n}") for k in range(50) for n in range(3) if k % 7 == 0 or n == k % 3]
    df = spark.createDataFrame(rows, "k int, batch int, text string")
    want = {k: (k, text) for k, _, text in sorted(rows, key=lambda r: r[1])}
    for few in (1000, 0):                        # told apart by a broadcast, grouped
        got = runner.newest_rows(df, ["k"], "batch", few)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want.values(), key=str)
        assert ("Exchange hashpartitioning" in got._jdf.queryExecution().executedPlan().toString()) == (few == 0)
    twice = runner.newest_rows(df.union(df), ["k"], "batch")
    assert twice.count() == len(want)            # one row per key, even if a batch has several


def test_landed_lines_are_compressed(spark):
    path = fixtures.landed_lines(spark, "/root/testdata/sf0.001")
    names = [n for _, _, files in os.walk(path) for n in files if n.startswith("part-")]
    assert names and all(n.endswith(".json.gz") for n in names)


def test_a_scan_meets_brackets_not_strings():
    text = json.dumps([{f"k{i}": 'a "quoted" \\ }' for i in range(50)} for _ in range(20)])
    assert len(splitjson._TOKEN.findall(text)) == 42 + 1     # brackets and the end
