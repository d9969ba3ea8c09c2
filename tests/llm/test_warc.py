import base64
import hashlib
import io
import zlib

import pytest
from pyspark.sql import functions as F

from llm_fixtures import prepared  # noqa: F401
from quarry.llm import warc

PAGES = "page_id long, url string, html string"


def expected(rows, min_bytes=0):
    first = {}
    for page_id, _, html in rows:
        body = (html or "").encode()
        if page_id is not None and len(body) >= min_bytes:
            first[body] = min(page_id, first.get(body, page_id))
    size = {b: sum((h or "").encode() == b for _, _, h in rows) for b in first}
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        low = first.get(body)
        again = low is not None and size[body] > 1 and page_id != low
        out.append((page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "revisit" if again else "response", low if again else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rows = [(i, f"http://x/{i}", f"<p>{i % 7}</p>" * (i % 5)) for i in range(200)]
    rows += [(900, None, None), (901, "http://a b", ""), (902, "u", "é🙂" * 100_000), (903, "u", "é🙂" * 100_000),
             (None, "u", "no id"), (None, None, "<p>1</p>"), (7, "http://x/7", "<p>0</p>" * 2),
             (904, "u", "\x1f WARC/1.1\r\n\r\n"), (905, "u", "".join(chr(33 + i * i % 90) for i in range(50_000)))]
    return rows


@pytest.mark.parametrize("split,archive,min_bytes", [(4 << 20, 1 << 30, 0), (97, 5000, 0), (1000, 1 << 30, 10)])
def test_round_trip(spark, rows, scratch, split, archive, min_bytes):
    pages = spark.createDataFrame(rows, PAGES).withColumn("payload", F.lit("clash")).repartition(3)
    files = warc.write_archives(pages, "page_id", "url", "html", scratch, min_bytes, archive)
    got = warc.read_archives(files, split).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in got), key=str) == expected(rows, min_bytes)
    assert all(r.digest_ok for r in got if r.record_type == "response")
    assert {r.page_id: bytes(r.payload) for r in got if r.page_id == 902} == {902: ("é🙂" * 100_000).encode()}


def test_no_pages(spark, scratch):
    files = warc.write_archives(spark.createDataFrame([], PAGES), "page_id", "url", "html", scratch)
    assert warc.read_archives(files).count() == 0


def test_false_magic_inside_a_record():
    noise = bytes(range(256)) * 20 + warc.MAGIC + b"\x00" * 10 + zlib.compress(b"x") + warc.MAGIC
    data = warc.record(1, "u", noise, None) + warc.record(2, "u", b"second", None)
    f, at, found = io.BytesIO(data), 0, []
    while (at := warc._find(f, at, len(data))) >= 0:
        member = warc._member(f, at)
        if member:
            found.append(warc.parse(member[0])["page_id"])
        at += member[1] if member else 1
    assert found == [1, 2]
    # a reader that starts anywhere finds the records after it, and nothing else
    second = len(warc.record(1, "u", noise, None))
    for start in range(1, second, 13):
        at = warc._find(f, start, len(data))
        while warc._member(f, at) is None:
            at = warc._find(f, at + 1, len(data))
        assert at == second
