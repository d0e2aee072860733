import subprocess
import sys
from pathlib import Path

import pytest

from vernissage import session

ROOT = Path(__file__).resolve().parents[1]


def test_small_rows_refuses_large_tables(spark):
    assert len(session.small_rows(spark.range(3), 3, "x")) == 3
    with pytest.raises(ValueError, match="more than 2"):
        session.small_rows(spark.range(3), 2, "x")


def test_broadcast_only_if_counted_small(spark):
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(session.broadcast_if_small(spark.range(3), 3))
    assert "broadcast" not in plan(session.broadcast_if_small(spark.range(4), 3))


def test_checkpoint_cuts_lineage(spark):
    df = session.checkpoint(spark.range(10).filter("id > 3"))
    assert "ExistingRDD" in df._jdf.queryExecution().executedPlan().toString() and df.count() == 6


def test_workers_find_the_package_from_any_folder(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from vernissage.session import build_session
from vernissage.functions import payload
s = build_session(cores=2)
df = s.createDataFrame([('x = [1]',)], 'h string').select(payload.assigned_udf('x')('h').alias('v'))
assert df.first().v == '[1]'
"""
    r = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=180)
    assert r.returncode == 0, r.stderr[-2000:]
