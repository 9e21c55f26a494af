"""The driver may load ``__spark_entry__.py`` by file path from another
working directory with no PYTHONPATH: the package must import and the
pandas scoring (run in Python workers) must still work."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spec = importlib.util.spec_from_file_location("entry_mod", {os.path.join(ROOT, "__spark_entry__.py")!r})
mod = importlib.util.module_from_spec(spec)
spec.loader.exec_module(mod)
assert mod.entry(spark).count() > 0
assert mod.queries()["predict_duration"](spark, "/root/testdata/sf0.001").count() > 0
print("OK")
"""


def test_entry_loads_by_path_without_pythonpath():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    cwd = tempfile.mkdtemp(prefix="farebox-entry-")
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "OK" in out.stdout, out.stderr[-2000:]
