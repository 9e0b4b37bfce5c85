"""Tasks need no installed copy of the package."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
RUN = """
import sys
sys.path.insert(0, {root!r})  # the driver's own path; workers don't have it
from pyspark.sql import SparkSession
spark = (
    SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
    .config("spark.checkpoint.dir", {work!r}).getOrCreate()
)
spark.sparkContext.setLogLevel("ERROR")

def seen(_):
    import importlib.util
    yield importlib.util.find_spec("streamfuse") is not None

assert not any(spark.sparkContext.parallelize(range(8), 8).mapPartitions(seen).collect())
import __spark_entry__ as entry
for name, query in entry.queries().items():
    if name.startswith("op") or name == "pipeline":
        query(spark, {data!r}).write.format("noop").mode("overwrite").save()
        print("ran", name, flush=True)
"""


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="test tables are not here")
def test_queries_run_on_workers_without_the_package(tmp_path):
    script = RUN.format(root=str(ROOT), work=str(tmp_path / "shared"), data="/root/testdata/sf0.001")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    (tmp_path / "elsewhere").mkdir()
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path / "elsewhere", env=env, capture_output=True, text=True, timeout=900
    )
    assert done.returncode == 0, done.stderr[-3000:]
    ran = [line.split()[1] for line in done.stdout.splitlines() if line.startswith("ran ")]
    assert len(ran) == 14 and "pipeline" in ran
