"""Documents read in blocks: the same elements as json.loads gives, however they are cut."""
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from oracle_compare import compare, duck
from quarry.plans import all_oracles, all_queries
from quarry.sources import schemas, splitjson

SF = "/root/testdata/sf0.01"


def _document(rng, n):
    odd = ['}{', '"}],"events":[{', "\\", '\\"', "]}", "é🙂 }", "{\"id\": 1}", "line\nbreak", ""]
    return {"events": [], "title": "}] not \"events\": [", "other": [{"events": [{"id": "no"}], "x": "}"}, [1, "}"]],
            "nested": {"events": [{"id": "neither"}, {"deep": {"er": []}}]},
            "description": rng.choice(odd),
            "events2": [{"id": "nor this"}],
            } | {"events": [{"id": str(i), "text": "".join(rng.choices(odd, k=rng.randint(0, 5))),
                             "list": [{"a": rng.choice(odd)}] * rng.randint(0, 3), "empty": {}} for i in range(n)]}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng = random.Random(5)
    path = tmp_path_factory.mktemp("docs")
    documents = {"a": _document(rng, 40), "b": _document(rng, 0), "c": _document(rng, 1), "d": {"x": 1}, "e": _document(rng, 250)}
    # one line, indented, ASCII only, keys in another order
    for k, (name, doc) in enumerate(documents.items()):
        doc = dict(sorted(doc.items(), reverse=k % 2 == 0))
        (path / f"{name}.json").write_text(json.dumps(doc, indent=[None, 2, 1][k % 3], ensure_ascii=k % 2 == 0), encoding="utf-8")
    return str(path), documents


@pytest.mark.parametrize("block_bytes,few", [(None, 10**6), (1500, 10**6), (1500, 0), (61, 10**6)])
def test_elements_of_blocks(spark, folder, block_bytes, few, monkeypatch):
    monkeypatch.setattr(splitjson, "_CHUNK", 500)
    path, documents = folder
    if block_bytes == 61:                                    # blocks far shorter than an element
        path, documents = os.path.join(path, "a.json"), {"a": documents["a"]}
    rows = splitjson.array_elements(spark, path, "events", block_bytes, few).collect()
    for name, doc in documents.items():
        got = [json.loads(r.element) for r in rows if r.file.endswith(f"/{name}.json")]
        assert sorted(got, key=lambda e: int(e["id"])) == doc.get("events", [])


def test_one_document_is_read_by_many_tasks(spark, folder):
    path, documents = folder
    with splitjson._split_size(spark, 1000):
        pieces = splitjson._pieces(spark, os.path.join(path, "e.json"))
        blocks = pieces.select("start", F.spark_partition_id().alias("task")).distinct().collect()
    assert len({b.task for b in blocks}) == len({b.start for b in blocks}) > 20


def test_query_equals_the_whole_file_reader(spark):
    assert compare(all_queries()["json_split_scan"](spark, SF), duck(SF), all_oracles()["json_split_scan"]) == []


def test_empty_folder_of_documents_and_schema_options(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"events": [{"d": "01/02/2024", "v": "x"}, 5, null, {"d": null, "v": 2}]}')
    rows = splitjson.read_array(spark, str(tmp_path), "events", "d date, v double", dateFormat="dd/MM/yyyy")
    assert sorted((str(r.events.d), r.events.v) for r in rows.collect()) == [("2024-02-01", None), ("None", 2.0)]
    assert schemas.EVENT_DOC_SCHEMA["events"].dataType.elementType is not None
