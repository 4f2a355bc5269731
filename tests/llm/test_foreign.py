"""Queries and pipeline in a process of its own, from another folder: executors have no copy of the package on their path."""

import os
import subprocess
import sys

from ..conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})  # of the driver alone
import __spark_entry__
from scorekit.session import local_session
spark = local_session(cores=4, shuffle_partitions=4, driver_memory="4g")
def look(it):
    import importlib.util
    import pyarrow as pa
    for _ in it:
        yield pa.RecordBatch.from_pydict({{"there": [importlib.util.find_spec("scorekit") is not None]}})
assert [r.there for r in spark.range(1, numPartitions=1).mapInArrow(look, "there boolean").collect()] == [False]
for name, query in __spark_entry__.queries().items():
    if name == "pipeline" or name.startswith("op"):
        if name.startswith("op") and not name[2:].split("_")[0].isdigit():
            continue
        print("ran", name, query(spark, {SF_SMALL!r}).count(), flush=True)
spark.stop()
"""


def test_executors_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    ran = [line.split()[1] for line in out.stdout.splitlines() if line.startswith("ran ")]
    assert out.returncode == 0, out.stderr[-3000:]
    assert len(ran) == 14 and "pipeline" in ran
