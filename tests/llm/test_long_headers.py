"""A record's header may be of any length."""
import base64
import io
import random

import pytest

from llm_fixtures import prepared  # noqa: F401
from quarry.llm import warc

URLS = {"plain": "http://x/" + "a" * 4_000_000,
        "data": "data:text/html;base64," + base64.b64encode(random.Random(1).randbytes(400_000)).decode()}


@pytest.mark.parametrize("kind", sorted(URLS))
def test_member_with_a_long_url(kind):
    data = warc.record(1, URLS[kind], b"page", None)
    found, size = warc._member(io.BytesIO(data + warc.record(2, "u", b"", None)), 0)
    row = warc.parse(found)
    assert size == len(data) and row["url"] == URLS[kind] and row["payload"] == b"page"


@pytest.mark.parametrize("split", [4 << 20, 5000])
def test_pages_with_long_urls(spark, scratch, split):
    rows = [(i, url, f"page {i}") for i, url in enumerate([*URLS.values(), "http://x/1", None])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    files = warc.write_archives(pages.repartition(1), "page_id", "url", "html", scratch)
    got = warc.read_archives(files, split).collect()
    assert sorted((r.page_id, r.url, r.payload.decode()) for r in got) == rows
