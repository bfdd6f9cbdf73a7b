"""Python workers find the package wherever the driver runs."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from millrace.session import local_session, prepare
spark = prepare(local_session("2"))

def names(batches):
    import millrace.schemas as schemas
    for batch in batches:
        yield batch
        assert schemas.IN == "IN"

assert spark.range(10).mapInArrow(names, "id long").count() == 10
print("found")
"""


def test_workers_import_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, ROOT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "found" in done.stdout, done.stderr[-2000:]
