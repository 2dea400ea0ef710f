"""The driver may load __spark_entry__.py by path from any directory."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("spark_entry", {os.path.join(ROOT, "__spark_entry__.py")!r})
m = importlib.util.module_from_spec(spec)
spec.loader.exec_module(m)
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from numprof.plans import registry
print("ROWS", m.entry(s).count(), set(registry.queries()) <= set(m.queries()), set(registry.oracle_sql()) <= set(m.oracle_sql()))
"""


def test_entry_loads_by_path_from_elsewhere():
    cwd = tempfile.mkdtemp(prefix="numprof-entry-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=300)
    assert "ROWS 3 True True" in out.stdout, out.stderr[-2000:]
