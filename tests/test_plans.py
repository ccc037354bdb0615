"""Plan invariants of every registered query, and the bench output contract."""

import contextlib
import io
import json
import os
import re
import subprocess
import sys

import pytest

from cadenza.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables missing")

FORBIDDEN = r"(CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython)"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_join_and_no_python(spark, name):
    df = QUERIES[name](spark, SF)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    assert not re.search(FORBIDDEN, buf.getvalue())


def test_no_ideal_gain_for_other_metrics(spark):
    for name in ("average_precision", "precision_at_k"):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[name](spark, SF).explain()
        assert not re.search(r"\bRange \(", buf.getvalue())


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="4")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=900)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == "0.001" and "errors" not in result
    assert all(isinstance(v, float) for v in result["queries"].values())
