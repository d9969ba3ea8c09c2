"""The polled source's offsets: start, gaps, retention, bounded steps, repeated landing."""
import datetime as dt
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from quarry.sources import poll
from quarry.streaming import runner, supervise
from test_streaming import _land


def _run(spark, land, location, **options):
    runner.run(poll.datapoint_stream(spark, land, **options), "log", "append", location=location)
    return sorted(r["index"] for r in runner.StreamResult(spark, location, "append").table().collect())


def _indexes(*payloads):
    return [5 * p + j for p in payloads for j in range(1, 6)]


def test_numbering_that_starts_at_one(spark, scratch):
    land = os.path.join(scratch, "landed")
    _land(land, 1, 2, dt.datetime(2024, 1, 1))
    assert poll.LandedPayloadStreamReader(land).latestOffset() == {"file": 2}
    assert _run(spark, land, os.path.join(scratch, "a")) == _indexes(1, 2)
    assert _run(spark, land, os.path.join(scratch, "b"), startFile=2) == _indexes(2)


def test_removed_files_do_not_stop_a_restart(spark, scratch):
    land, location = os.path.join(scratch, "landed"), os.path.join(scratch, "q")
    _land(land, 0, 3, dt.datetime(2024, 1, 1))
    assert _run(spark, land, location) == _indexes(0, 1, 2)
    assert poll.retain(land, 2) == [0, 1]
    _land(land, 3, 1, dt.datetime(2024, 1, 1, 0, 1))
    assert _run(spark, land, location) == _indexes(0, 1, 2, 3)
    assert poll.retain(land, 4) == [2, 3]                     # nothing is left
    assert _run(spark, land, location) == _indexes(0, 1, 2, 3)
    _land(land, 4, 1, dt.datetime(2024, 1, 1, 0, 2))
    assert _run(spark, land, location) == _indexes(0, 1, 2, 3, 4)


def test_files_removed_unread_fail_the_query_unless_allowed(spark, scratch):
    land, location = os.path.join(scratch, "landed"), os.path.join(scratch, "q")
    _land(land, 0, 1, dt.datetime(2024, 1, 1))
    assert _run(spark, land, location) == _indexes(0)
    _land(land, 1, 3, dt.datetime(2024, 1, 1, 0, 1))
    shutil.rmtree(os.path.join(land, "file_no=0"))
    shutil.rmtree(os.path.join(land, "file_no=1"))
    with pytest.raises(Exception, match="went away before they were read"):
        _run(spark, land, location)
    assert _run(spark, land, location, failOnDataLoss="false") == _indexes(0, 2, 3)


def test_a_permanent_gap(spark, scratch):
    land, location = os.path.join(scratch, "landed"), os.path.join(scratch, "q")
    _land(land, 0, 2, dt.datetime(2024, 1, 1))
    _land(land, 3, 1, dt.datetime(2024, 1, 1, 0, 3))
    assert _run(spark, land, location) == _indexes(0, 1)       # 2 may still come
    poll.mark_gap(land, 2)
    assert _run(spark, land, location) == _indexes(0, 1, 3)
    with pytest.raises(ValueError):
        poll.mark_gap(land, 3)


def test_landing_a_number_again_keeps_the_first(scratch):
    src, land = os.path.join(scratch, "p.json"), os.path.join(scratch, "landed")
    for value in (7, 8):
        with open(src, "w") as fh:
            fh.write(json.dumps([{"2024-01-01T00:00:05": value}]))
        assert poll.land_payload("file://" + src, land, 0, 1) == 1
    assert os.listdir(land) == ["file_no=0"]
    with open(os.path.join(land, "file_no=0", "part-0.json")) as fh:
        assert json.loads(json.loads(fh.read())["body"]) == [{"2024-01-01T00:00:05": 7}]


def test_bounded_steps_resume_where_they_stood(spark, scratch):
    land, location = os.path.join(scratch, "landed"), os.path.join(scratch, "q")
    _land(land, 0, 5, dt.datetime(2024, 1, 1))
    options = {"maxFilesPerTrigger": 2, "consumer": "me"}

    def drain():
        result, _ = supervise.run_until_drained(
            spark, lambda _: poll.datapoint_stream(spark, land, **options), "steps", location=location, timeout_s=120)
        return sorted(r["index"] for r in result.table().collect())

    assert drain() == _indexes(0, 1, 2, 3, 4)
    ends = [json.loads(line)["file"] for n in sorted(os.listdir(f"{location}/checkpoint/offsets"), key=str)
            if not n.startswith(".") for line in open(f"{location}/checkpoint/offsets/{n}").read().splitlines()[2:]]
    assert sorted(ends) == [1, 3, 4]                         # no step has more than two files
    _land(land, 5, 3, dt.datetime(2024, 1, 1, 0, 5))
    assert drain() == _indexes(*range(8))
    with pytest.raises(ValueError):
        poll.LandedPayloadStreamReader(land, {"maxFilesPerTrigger": "2"})


def test_supervision_gives_up_after_its_retries(spark, scratch):
    land = os.path.join(scratch, "landed")
    _land(land, 0, 1, dt.datetime(2024, 1, 1))
    attempts = []

    def build(attempt):
        attempts.append(attempt)
        return poll.datapoint_stream(spark, land).withColumn("index", F.raise_error(F.lit("always")).cast("long"))

    with pytest.raises(Exception, match="always"):
        supervise.run_until_drained(spark, build, "fails", retries=2, timeout_s=120)
    assert attempts == [0, 1, 2]
