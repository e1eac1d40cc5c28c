"""bench.py prints the one-line JSON the driver records (run in its own JVM)."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF001


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2", BENCH_REPEAT="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=900, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    result = json.loads(out[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {f"a{i:02d}" for i in range(1, 11)}
    assert result["value"] > 0 and result["report_job_failed"] == []
