"""bench.py prints exactly one JSON line with the expected keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="gold_features,priority_summary", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True,
                         timeout=600, env=env, cwd=str(tmp_path))
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stderr[-2000:]
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and d["metric"] == "total_query_seconds"
    assert set(d["queries"]) == {"silver_layer", "gold_layer", "gold_features", "priority_summary"}
    assert d["training_text"] == {}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-6
