"""The queries give rows where workers cannot import the package."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as e
q = e.queries()
for name in [n for n in q if n.startswith("op") or n == "pipeline"]:
    assert q[name](spark, "/root/testdata/sf0.001").count() > 0, name
    print(name)
print("done")
"""


def test_all_queries_from_another_folder(tmp_path):
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert out.stdout.strip().endswith("done"), out.stdout + out.stderr[-2000:]
    assert len(out.stdout.split()) == 15
