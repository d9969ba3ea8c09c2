"""Polled payload source (restartable, exactly-once).

A poller fetches payloads (HTTP or file URLs) and *lands* them as numbered
files before Spark sees them; the stream source then reads landed files by
number.  Offsets are file numbers, ranges are half-open ``(start, end]``, and
each file is one input partition read on an executor, so a restarted query
replays exactly the files after its last committed offset.

What the folders alone cannot tell is kept in a log beside them (``_log``):

* ``gap=<n>``: file n will never land (``mark_gap``);
* ``floor=<n>``: the files below n were removed (``retain``);
* ``at-<consumer>``: the last offset that a named consumer was given, which
  bounds its next step.

Landed layout::

    <dir>/file_no=<n>/part-*.json    one JSON line per payload:
        {"payload": <n>, "first_index": <i>, "body": "<wire text>"}

Wire text of one payload (fixed format): ``[{"<yyyy-MM-dd'T'HH:mm:ss>": <int>}, ...]``.
"""

from __future__ import annotations

import json
import os
import re
import shutil
import urllib.request
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader,
                                    DataSourceStreamReader, InputPartition)

from quarry.sources.schemas import PAYLOAD_TS_FORMAT, PAYLOAD_WIRE_TYPE

LANDED_SCHEMA = "payload BIGINT, first_index BIGINT, body STRING"
_DIR_RE = re.compile(r"^file_no=(\d+)$")


# ----------------------------------------------------------------- landing
def payload_body(entries: Column) -> Column:
    """Wire text from a list of struct(order_key, ts_text, v): newest first."""
    ordered = F.sort_array(entries, asc=False)
    return F.to_json(F.transform(ordered, lambda e: F.create_map(e["ts_text"], e["v"])))


def write_landed(payloads: DataFrame, path: str, per_file: int) -> None:
    """Land (payload, first_index, body) rows as numbered files."""
    (payloads.withColumn("file_no", F.floor(F.col("payload") / per_file))
     .repartition("file_no")
     .write.mode("overwrite").partitionBy("file_no").json(path))


def land_payload(url: str, landing_dir: str, payload_no: int, first_index: int,
                 timeout: float = 10.0) -> int:
    """Poll one payload and land it as file number ``payload_no``.

    The file is written into a hidden folder, and the folder is renamed: a
    reader sees the whole payload or nothing.  A failed poll raises (the
    caller retries); it never kills the stream silently.  Landing a number
    again replaces nothing: the first one stays.  Returns the number of
    datapoints landed.
    """
    with urllib.request.urlopen(url, timeout=timeout) as resp:
        status = getattr(resp, "status", 200)
        if status not in (None, 200):
            raise IOError(f"poll of {url} returned HTTP {status}")
        body = resp.read().decode("utf-8").strip()
    n = len(json.loads(body))
    landing_dir = _local(landing_dir)
    hidden = os.path.join(landing_dir, f".{payload_no}-{uuid.uuid4().hex}")
    os.makedirs(hidden)
    with open(os.path.join(hidden, "part-0.json"), "w", encoding="utf-8") as fh:
        fh.write(json.dumps({"payload": payload_no, "first_index": first_index, "body": body}) + "\n")
    target = os.path.join(landing_dir, f"file_no={payload_no}")
    try:
        os.rename(hidden, target)
    except OSError:
        if not _committed(target):
            raise
        shutil.rmtree(hidden)                    # landed before, perhaps by this call's first try
    return n


# --------------------------------------------------------------- offset log
def _log_dir(root: str) -> str:
    return os.path.join(_local(root), "_log")


def _log(root: str, name: str, text: str = "") -> None:
    """An entry of the log; replaces one of the same name as a whole."""
    os.makedirs(_log_dir(root), exist_ok=True)
    hidden = os.path.join(_log_dir(root), f".{uuid.uuid4().hex}")
    with open(hidden, "w", encoding="utf-8") as fh:
        fh.write(text)
    os.replace(hidden, os.path.join(_log_dir(root), name))


def _logged(root: str, kind: str) -> list[int]:
    if not os.path.isdir(_log_dir(root)):
        return []
    return [int(n[len(kind) + 1:]) for n in os.listdir(_log_dir(root)) if n.startswith(f"{kind}=")]


def mark_gap(landing_dir: str, payload_no: int) -> None:
    """File ``payload_no`` will never land: readers go on behind it.  One that
    has landed cannot be declared a gap."""
    if _committed(os.path.join(_local(landing_dir), f"file_no={payload_no}")):
        raise ValueError(f"file {payload_no} has landed")
    _log(landing_dir, f"gap={payload_no}")


def retain(landing_dir: str, first_kept: int) -> list[int]:
    """Remove the files below ``first_kept`` (the log knows first, so that a
    reader never takes them for missing); returns their numbers."""
    _log(landing_dir, f"floor={first_kept}")
    old = [n for n in _landed_numbers(landing_dir) if n < first_kept]
    for n in old:
        shutil.rmtree(os.path.join(_local(landing_dir), f"file_no={n}"))
    return old


# ------------------------------------------------------------------ decode
def _parsed(landed: DataFrame) -> DataFrame:
    """``landed`` with ``_entries`` (array of key, value) and ``_bad``: not the
    wire form, that is no array of maps, or a time or value that does not parse."""
    entries = F.flatten(F.transform(F.from_json("body", PAYLOAD_WIRE_TYPE), F.map_entries))
    odd = F.exists("_entries", lambda e: e["value"].isNull()
                   | F.try_to_timestamp(e["key"], F.lit(PAYLOAD_TS_FORMAT)).isNull())
    return (landed.withColumn("_entries", entries)
            .withColumn("_bad", F.coalesce(F.col("_entries").isNull() | odd, F.lit(True))))


def rejected_payloads(landed: DataFrame) -> DataFrame:
    """The landed payloads that cannot be decoded, as they came."""
    return _parsed(landed).where("_bad").select(landed.columns)


def decode_payloads(landed: DataFrame, malformed: str = "fail") -> DataFrame:
    """Landed payload rows -> datapoints (timestamp, value, index).

    Every entry of every map is kept; ``index`` numbers datapoints in arrival
    order (wire order), starting at the payload's ``first_index``.  A malformed
    payload fails the query; with ``malformed="skip"`` it yields no row, and
    ``rejected_payloads`` of the same input has it.
    """
    if malformed not in ("fail", "skip"):
        raise ValueError(f"malformed must be fail or skip, not {malformed!r}")
    rows = _parsed(landed)
    if malformed == "skip":
        rows = rows.where(~F.col("_bad"))
    text = F.concat(F.lit("malformed payload "), F.coalesce(F.col("payload").cast("string"), F.lit("?")))
    entries = F.when(F.col("_bad"), F.raise_error(text)).otherwise(F.col("_entries"))
    return (rows.select("first_index", F.posexplode(entries).alias("pos", "e"))
            .select(F.to_timestamp(F.col("e.key"), PAYLOAD_TS_FORMAT).alias("timestamp"),
                    F.col("e.value").alias("value"),
                    (F.col("first_index") + F.col("pos")).alias("index")))


# ------------------------------------------------------------- data source
class _FilePartition(InputPartition):
    def __init__(self, file_no: int, directory: str):
        super().__init__(file_no)
        self.file_no = file_no
        self.directory = directory


def _local(path: str) -> str:
    """The path of a mounted folder; the Python source reads no other store."""
    if "://" in path and not path.startswith("file:"):
        raise ValueError(f"landed_payloads reads mounted folders only, not {path}: use datapoint_file_stream")
    return "/" + path[len("file:"):].lstrip("/") if path.startswith("file:") else path


def _landed_numbers(root: str) -> list[int]:
    """Numbers of the landed files, ascending; a folder counts once it holds a
    committed file."""
    root = _local(root)
    if not os.path.isdir(root):
        raise FileNotFoundError(f"landing folder {root} does not exist")
    found = [(int(m.group(1)), name) for name in os.listdir(root) if (m := _DIR_RE.match(name))]
    return sorted(n for n, name in found if _committed(os.path.join(root, name)))


def _committed(folder: str) -> bool:
    return os.path.isdir(folder) and any(f.endswith(".json") and f[0] not in "._" for f in os.listdir(folder))


def _first(root: str, start: int | None) -> int:
    """The number that reading begins with: ``start``, or the smallest that has
    landed (0 if none has); files that retention removed are behind it."""
    numbers = _landed_numbers(root)
    first = start if start is not None else min(numbers, default=0)
    return max([first, *_logged(root, "floor")])


def _contiguous(root: str, start: int) -> int:
    """The last number up to which every file after ``start`` has landed, was
    removed by retention, or is a gap."""
    n = max([start, *(f - 1 for f in _logged(root, "floor"))])
    have = {*_landed_numbers(root), *_logged(root, "gap")}
    while n + 1 in have:
        n += 1
    return n


def _read_landed_dir(directory: str):
    """All payloads of one landed file as one Arrow batch (a landed file
    holds a bounded number of payloads)."""
    import pyarrow as pa

    directory = _local(directory)
    payload, first, body = [], [], []
    for name in sorted(os.listdir(directory)):
        if name.startswith(".") or name.startswith("_") or not name.endswith(".json"):
            continue
        with urllib.request.urlopen("file://" + os.path.join(directory, name)) as fh:
            for raw in fh:
                line = raw.decode("utf-8").strip()
                if line:
                    rec = json.loads(line)
                    payload.append(rec["payload"])
                    first.append(rec["first_index"])
                    body.append(rec["body"])
    if payload:
        yield pa.RecordBatch.from_arrays(
            [pa.array(payload, pa.int64()), pa.array(first, pa.int64()), pa.array(body, pa.string())],
            names=["payload", "first_index", "body"])


class LandedPayloadStreamReader(DataSourceStreamReader):
    """Offsets are the last number of a gapless run: a file that lands out of
    order holds back those after it, and none is passed over.

    Options: ``startFile``, the first number (default: the smallest that has
    landed when the query first starts); ``maxFilesPerTrigger`` with
    ``consumer``, the files of a step at most and the name under which the
    log keeps how far this query was given files (one name per checkpoint);
    ``failOnDataLoss`` (default true): a file that went away unread, by no
    ``retain``, fails the query.
    """

    def __init__(self, path: str, options: dict | None = None):
        options = {k.lower(): v for k, v in (options or {}).items()}
        self.path = path
        self.start = int(options["startfile"]) if "startfile" in options else None
        self.step = int(options["maxfilespertrigger"]) if "maxfilespertrigger" in options else None
        self.consumer = options.get("consumer")
        self.strict = options.get("failondataloss", "true").lower() == "true"
        if self.step is not None and (self.step < 1 or not self.consumer):
            raise ValueError("maxFilesPerTrigger needs a positive number and a consumer name")
        self.seen: int | None = None

    def _given(self) -> int:
        """The offset to go on from."""
        at = os.path.join(_log_dir(self.path), f"at-{self.consumer}")
        if self.consumer and os.path.exists(at):
            with open(at, encoding="utf-8") as fh:
                return int(fh.read())
        return _first(self.path, self.start) - 1

    def initialOffset(self) -> dict:
        return {"file": _first(self.path, self.start) - 1}

    def latestOffset(self) -> dict:
        # a new reader may resume a query: what that query was given is in the log, or all that is there
        given = self._given() if self.seen is None else self.seen
        end = _contiguous(self.path, given)
        self.seen = end if self.step is None else min(end, given + self.step)
        return {"file": self.seen}

    def partitions(self, start: dict, end: dict):
        lo, hi = start["file"], end["file"]
        if hi < lo:
            raise RuntimeError(f"file {lo} was read, but the landing folder ends at {hi}: removed without retain()?")
        if self.consumer and hi > lo:
            _log(self.path, f"at-{self.consumer}", str(hi))
            self.seen = max(hi, self.seen if self.seen is not None else hi)
        landed = set(_landed_numbers(self.path))
        known = set(_logged(self.path, "gap"))
        floor = max(_logged(self.path, "floor"), default=0)
        wanted = range(max(lo + 1, floor), hi + 1)
        lost = [n for n in wanted if n not in landed and n not in known]
        if lost and self.strict:
            raise RuntimeError(f"landed files {lost[:10]} went away before they were read")
        return [_FilePartition(n, os.path.join(self.path, f"file_no={n}")) for n in wanted if n in landed]

    def read(self, partition: _FilePartition):
        yield from _read_landed_dir(partition.directory)

    def commit(self, end: dict) -> None:
        # Landed files are the durable log; nothing to drop in memory.
        pass


class LandedPayloadBatchReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return [_FilePartition(n, os.path.join(self.path, f"file_no={n}"))
                for n in _landed_numbers(self.path)]

    def read(self, partition: _FilePartition):
        yield from _read_landed_dir(partition.directory)


class LandedPayloadSource(DataSource):
    """``spark.readStream.format("landed_payloads").load(dir)``."""

    @classmethod
    def name(cls) -> str:
        return "landed_payloads"

    def schema(self) -> str:
        return LANDED_SCHEMA

    def _path(self) -> str:
        path = self.options.get("path")
        if not path:
            raise ValueError("landed_payloads needs a path")
        return path

    def streamReader(self, schema):
        return LandedPayloadStreamReader(self._path(), dict(self.options))

    def reader(self, schema):
        return LandedPayloadBatchReader(self._path())


def register(spark: SparkSession) -> None:
    # Serialize this module's classes by value: the data source is planned
    # and read in Python workers that need not have this package installed.
    import sys

    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(LandedPayloadSource)


def datapoint_stream(spark: SparkSession, landing_dir: str, **options) -> DataFrame:
    """Streaming datapoints (timestamp, value, index) from landed payloads, by
    file number (options: see ``LandedPayloadStreamReader``)."""
    register(spark)
    return decode_payloads(spark.readStream.format("landed_payloads").options(**options).load(landing_dir))


def datapoints(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Batch form of the same source."""
    register(spark)
    return decode_payloads(spark.read.format("landed_payloads").load(landing_dir))


def landed_files(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Landed payloads through Spark's own JSON source, with their ``file_no``;
    a filter on it prunes files."""
    return spark.read.schema(LANDED_SCHEMA + ", file_no BIGINT").json(landing_dir)


def datapoint_file_stream(spark: SparkSession, landing_dir: str,
                          max_files_per_trigger: int | None = None) -> DataFrame:
    """The landed payloads through Spark's built-in file source: any store,
    bounded batches (``maxFilesPerTrigger``), the same exactly-once guarantee
    from its checkpoint, and late landings in any order.

    (The Python stream reader API of Spark 4.1 is not asked for bounded steps;
    ``LandedPayloadStreamReader`` bounds them itself, for runs by processing time.)
    """
    reader = spark.readStream.schema(LANDED_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return decode_payloads(reader.option("recursiveFileLookup", "true").json(landing_dir))
