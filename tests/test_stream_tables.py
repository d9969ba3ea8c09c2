"""Streams over a table that is a folder of several files."""
import os

import pytest

from oracle_compare import _norm
from quarry.plans import all_queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("many"))
    spark.read.parquet(f"{SF}/events.parquet").repartition(5).write.parquet(os.path.join(folder, "events.parquet"))
    return folder


@pytest.mark.parametrize("name", ["stream_tumbling", "stream_tumbling_append", "stream_tumbling_update"])
def test_windows_of_a_folder_equal_those_of_one_file(spark, many, name):
    def rows(sf_dir):
        return sorted(tuple(map(_norm, r)) for r in all_queries()[name](spark, sf_dir).collect())

    assert rows(many) == rows(SF)
    if name == "stream_tumbling":
        assert rows(many) == sorted(tuple(map(_norm, r)) for r in all_queries()["window_stats"](spark, many).collect())
