"""The operators run in a process that was started in another folder, without the package on its workers' path."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from clickloom.session import build_session, ship_package
from clickloom.llm.divergence import audit
spark = build_session("elsewhere", "local[2]", **{{"spark.sql.shuffle.partitions": "2"}})
ship_package(spark)
rows = [("a b", "en", s) for s in "xyz"]
print("ROWS", audit(spark.createDataFrame(rows, "text string, lang string, source string")).count())
"""


def test_operators_run_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=280)
    assert "ROWS 6" in done.stdout, done.stderr[-9000:]
