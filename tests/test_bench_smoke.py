"""bench.py prints one JSON line with the driver's keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "kpi_row", "model_gold_calendar_busy_hours"],
                         env=env, capture_output=True, text=True, timeout=600, cwd=ROOT)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    d = json.loads(lines[0])
    assert set(d) == {"metric", "value", "unit", "queries", "sf"} and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"kpi_row", "model_gold_calendar_busy_hours"} and d["value"] > 0
