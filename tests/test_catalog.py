"""Registered queries against DuckDB on the given tables.

The default run takes a cross-section; TIDEWICK_ALL=1 takes every query (also:
``python tests/compare.py <sf dir> [name prefix ...]``). An empty answer is a failure.
"""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect
from tidewick.plans.catalog import ORACLE, QUERIES

FULL = os.environ.get("TIDEWICK_ALL") == "1"
SF = "/root/testdata/sf0.01"
SAMPLE = ("flagship resample_bars_1hour change_1m tidy_series continuity_check positional_split "
          "drawdown performance_metrics next_trade_exit daily_risk_counters validate_signals "
          "rebalance extract_signal token_count semantic_topk token_budget_context "
          "retirement_candidates upsert_latest incremental_append infer_narrow_schema "
          "stream_ingest stream_momentum stream_decide prior_daily_counters").split()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE) if FULL else SAMPLE)
def test_matches_sql(spark, duck, name):
    out = compare(spark, duck, SF, entry.queries()[name], entry.oracle_sql()[name])
    assert out == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE) and len(QUERIES) > 160
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("without", [("tidewick/llm", "tests/llm"), ("tidewick/llm", "tests/llm", "corpus_pipeline.py")])
def test_imports_without_text_operators(tmp_path, without):
    """A copy without that subpackage has all other queries."""
    root = Path(entry.__file__).parent
    gone = {str(root / x) for x in without}
    shutil.copytree(root, tmp_path / "copy", ignore=lambda folder, names: {
        x for x in names if x in (".git", "__pycache__") or f"{folder}/{x}" in gone})
    code = "import __spark_entry__ as e, tests.compare; print(len(e.queries()), any(x.startswith('op') and x[2:3].isdigit() for x in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == [str(len(QUERIES)), "False"], out.stderr[-500:]


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
