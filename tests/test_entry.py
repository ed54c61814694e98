"""The entry module with and without its optional parts, each in a process of its own."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
REPORT = """
import __spark_entry__ as E
from workload.queries import QUERIES
assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())
print(len(set(E.queries()) - set(QUERIES)))
"""


@pytest.mark.parametrize("hidden, left", [
    ("ahocorasick", 0), ("tidewatch.llm", 0), ("corpus_pipeline", None)])
def test_core_queries_stay_without_optional_parts(hidden, left):
    code = f"import sys\nsys.modules[{hidden!r}] = None\n{REPORT}"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    if left is not None:
        assert int(done.stdout) == left
