"""The entry module where the training-data operators are left out."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]

SCRIPT = """
import __spark_entry__ as e
from pyspark.sql import SparkSession
names = e.queries().keys()
assert not [n for n in names if n.startswith("op") or n == "pipeline"] and names == e.oracle_sql().keys()
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", e.queries()["partition_names"](spark, "/root/testdata/sf0.001").count())
"""


def test_without_llm(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(REPO / "eventmart", copy / "eventmart", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(REPO / name, copy / name)
    run = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert int(run.stdout.split()[-1]) > 0
