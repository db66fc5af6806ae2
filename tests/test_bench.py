"""bench.py prints one JSON line of the agreed shape."""

import json
import os
import subprocess
import sys

from conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2", BENCH_QUERIES="fold,lookup", BENCH_REPEAT="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    b = json.loads(lines[0])
    assert b["unit"] == "sec" and b["value"] > 0 and set(b["queries"]) == {"fold", "lookup"}
    assert b["sf"] == "0.001" and "rows_per_sec" in b
