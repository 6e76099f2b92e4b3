"""bench.py prints exactly one JSON line with the driver's fields."""

import json
import os
import subprocess
import sys

from .conftest import ROOT, SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMALL, BENCH_CPUS="4")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "monthly_trend", "kpi_summary"],
                         capture_output=True, text=True, env=env, timeout=900, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(rec)
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and rec["errors"] == {}
    assert {"monthly_trend", "kpi_summary", "build_fact", "build_mart"} <= set(rec["queries"])
