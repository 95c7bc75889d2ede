"""The entry points work from another folder, without the package on the workers' path."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as e
q = e.queries()
assert e.entry(spark).count() > 0
for name in ("score_mlp", "stream_daily_change", "stream_score_dispatch", "src_files"):
    assert q[name](spark, "/root/testdata/sf0.001").count() > 0
print("done")
"""


def test_from_another_folder(tmp_path):
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("done"), out.stderr[-2000:]
