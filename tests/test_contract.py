"""The driver contract: __spark_entry__ shapes and bench.py's one JSON line."""

import json
import os
import subprocess
import sys

import __spark_entry__ as entry
from tests.conftest import ROOT, SF_SMALL


def test_entry_functions_have_the_contract_shapes(spark):
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert qs and set(sqls) <= set(qs) and all(callable(q) for q in qs.values())
    assert all(isinstance(v, str) and v.strip() for v in sqls.values())
    df = entry.entry(spark)
    assert df.columns == ["product_name", "category", "sub_category", "total_revenue", "total_profit",
                          "units_sold", "revenue_rank"]


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_RUNS="1", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["metric"] and d["value"] > 0 and d["sf"] == 0.001
    assert "q_month_product_by_month" in d["queries"] and "etl_load" in d["queries"]
