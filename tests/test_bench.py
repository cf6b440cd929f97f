"""bench.py prints one JSON line with the contract's keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_REPEAT="1", BENCH_CPUS="2",
               BENCH_DRIVER_MEM="2g")
    p = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "knn_topk", "vector_dims"],
                       env=env, capture_output=True, text=True, timeout=600, cwd=ROOT)
    lines = [ln for ln in p.stdout.splitlines() if ln.startswith("{")]
    assert p.returncode == 0 and len(lines) == 1
    out = json.loads(lines[0])
    assert out["unit"] == "sec" and out["sf"] == "0.001" and "failed" not in out
    assert set(out["queries"]) == {"knn_topk", "vector_dims"}
    assert abs(out["value"] - sum(out["queries"].values())) < 1e-2
