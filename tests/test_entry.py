"""The entry module where optional parts are missing."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = """
import sys, warnings
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name in {missing!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Absent())
with warnings.catch_warnings(record=True) as told:
    warnings.simplefilter("always")
    import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), any(n.startswith("op") for n in entry.queries()), len([w for w in told if "corpus" in str(w.message)]))
"""


@pytest.mark.parametrize(
    "missing, told", [(["millrace.llm", "corpus_pipeline"], 0), (["xxhash"], 1), (["public_tokenizers"], 1), (["regex"], 1)]
)
def test_core_queries_remain(missing, told):
    if not (ROOT / "corpus_pipeline.py").exists() and told:
        pytest.skip("without the corpus queries nothing is missing")
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(missing=missing)], cwd=ROOT, capture_output=True, text=True)
    n_queries, n_sql, corpus, warned = run.stdout.split()
    assert int(n_queries) >= 48 and int(n_sql) >= 48 and corpus == "False" and int(warned) == told, run.stderr
