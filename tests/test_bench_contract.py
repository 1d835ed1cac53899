"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="state_ranking,dedupe_latest", BENCH_MEM="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1
    b = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(b) and b["unit"] == "sec"
    assert set(b["queries"]) == {"layers_run", "state_ranking", "dedupe_latest"} and "errors" not in b
    assert b["sf"] == 0.001
