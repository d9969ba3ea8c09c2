"""Corrupt records: kept apart, counted, and none lost."""
import pytest

from oracle_compare import compare, duck
from quarry.plans import all_oracles, all_queries
from quarry.sources import readers

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["json_corrupt_records", "json_reject_counts"])
def test_queries(spark, name):
    assert compare(all_queries()[name](spark, SF), duck(SF), all_oracles()[name]) == []


def test_json_kinds(spark, tmp_path):
    lines = ['{"a": 1, "b": [1, 2]}', '{"a": "x", "b": [3]}', '{"a": 2, "b": "no list"}', '{"a": 3, "b"', "no json", "{}", "", "[]"]
    (tmp_path / "x.json").write_text("\n".join(lines))
    got = readers.read_json_checked(spark, str(tmp_path), "a INT, b ARRAY<INT>")
    assert sorted((r.a or 0, r.b) for r in got.good().collect()) == [(0, None), (1, [1, 2])]
    assert sorted((r.kind, r.raw) for r in got.rejects().collect()) == [
        ("bad_field", lines[1]), ("bad_field", lines[2]), ("broken", "no json"), ("broken", lines[3])]
    assert sorted((r.a or 0, r.b) for r in got.surviving().collect() if r.a or r.b) == [(0, [3]), (1, [1, 2]), (2, None)]
    assert all(r.file.endswith("x.json") for r in got.rejects().collect())
    assert {r.kind: r.n for r in got.counts().collect()} == {"good": 2, "bad_field": 2, "broken": 2}


def test_csv_kinds(spark, tmp_path):
    lines = ["d,v,s", "2024-01-02,1.5,x", "2024-01-03,many,y", "2024-01-04,2", "2024-01-05,3,z,more", "no day,4,w"]
    (tmp_path / "x.csv").write_text("\n".join(lines))
    got = readers.read_csv_checked(spark, str(tmp_path), "d DATE, v DOUBLE, s STRING")
    assert [(str(r.d), r.v, r.s) for r in got.good().collect()] == [("2024-01-02", 1.5, "x")]
    assert sorted((r.kind, r.raw) for r in got.rejects().collect()) == [
        ("bad_field", lines[2]), ("bad_field", lines[5]), ("broken", lines[3]), ("broken", lines[4])]
    assert sorted((r.v, r.s) for r in got.surviving().collect() if r.v) == [(1.5, "x"), (4.0, "w")]
