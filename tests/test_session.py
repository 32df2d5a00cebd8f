"""Shipping of the package and the shared folder."""

import os
import subprocess
import sys
import types

import pytest

from vigilframe import session

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
import __spark_entry__ as entry_point
from pyspark.sql import SparkSession
sys.path.remove({REPO!r})
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config(
    "spark.checkpoint.dir", sys.argv[1]).getOrCreate()
print("rows", entry_point.queries()["iforest_anomalies"](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_need_no_path(tmp_path):
    """A query with Python functions runs from a foreign folder without PYTHONPATH."""
    script = tmp_path / "run.py"
    script.write_text(SCRIPT)
    free = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script), str(tmp_path / "shared")], cwd=tmp_path, env=free, capture_output=True, text=True, timeout=300)
    assert "rows " in done.stdout and int(done.stdout.split()[-1]) > 0, done.stderr[-2000:]


def fake(spark, master, root=None):
    """The session, with another master and setting."""
    return types.SimpleNamespace(
        conf=types.SimpleNamespace(get=lambda key, default=None: root or default), _jvm=spark._jvm, _jsc=spark._jsc,
        sparkContext=types.SimpleNamespace(master=master))


def test_shared_folder(spark):
    assert session.checkpoint_root(fake(spark, "yarn", "hdfs://a/b/")) == "hdfs://a/b"
    assert session.checkpoint_root(fake(spark, "local[4]")) == session.LOCAL_ROOT
    for master in ("yarn", "spark://a:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            session.checkpoint_root(fake(spark, master))


def test_stages_lie_in_the_shared_folder(spark):
    root = session.checkpoint_root(spark)
    kept = session.materialize(spark.range(3), "kept")
    assert kept.count() == 3 and all(root in f and "/kept-" in f for f in kept.inputFiles())
