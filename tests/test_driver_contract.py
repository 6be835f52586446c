"""The driver contract from a plain session started in another directory:
Python workers (state machine, stateful streaming processor) must not rely on
the working directory to import this package."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
s = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
     .config("spark.ui.showConsoleProgress", "false").getOrCreate())
s.sparkContext.setLogLevel("ERROR")
import __spark_entry__ as E
assert E.entry(s).count() > 0
for n in ["status_counts", "vehicle_stream_replay"]:
    assert E.queries()[n](s, "/root/testdata/sf0.001").count() > 0, n
print("contract-ok")
"""


def test_contract_from_plain_session_elsewhere():
    cwd = tempfile.mkdtemp(prefix="gw-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                       timeout=900)
    assert "contract-ok" in r.stdout, r.stderr[-3000:]
