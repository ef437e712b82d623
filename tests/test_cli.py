"""The query-by-name entry point lists every registered query without starting Spark."""

import os
import subprocess
import sys

from rillflow.plans import all_queries

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_cli_lists_queries():
    out = subprocess.run([sys.executable, "-m", "rillflow"], cwd=ROOT, capture_output=True,
                         text=True, timeout=120)
    assert out.returncode == 0
    listed = out.stdout.split(":", 1)[1].strip().split(", ")
    assert sorted(listed) == sorted(all_queries())
