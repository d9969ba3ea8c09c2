"""The driver's view: a plain session, another working directory, and
queries whose Python parts (UDF, data source) run in Python workers."""
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
assert E.entry(spark).count() > 0
q = E.queries()
assert q["scalar_udf"](spark, "/root/testdata/sf0.001").count() == 1000
assert q["payload_decode"](spark, "/root/testdata/sf0.001").count() == 1000
assert q["offset_range"](spark, "/root/testdata/sf0.001").count() > 0
print("CONTRACT-OK")
"""


def test_entry_and_python_workers_from_another_directory():
    cwd = tempfile.mkdtemp(prefix="quarry-driver-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "CONTRACT-OK" in res.stdout, res.stderr[-3000:]
