"""Shared tables and checkpoints go when the application ends: looked at from outside its process."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from tillsight.session import build_session
spark = build_session("local[2]", 2, extra={{"spark.checkpoint.dir": {folder!r}}})
from tillsight.plans.registry import queries
from tillsight.shared import written
queries()["rfm_top_segment"](spark, {sf!r}).count()
spark.range(5).checkpoint()
{more}
print("FILES", sum(len(f) for _, _, f in __import__("os").walk({folder!r})))
"""
FAILING = """
try:
    written(spark.range(5).selectExpr("raise_error('no') AS x"), "failing")
except Exception:
    print("FAILED")
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver data not present")
@pytest.mark.parametrize("more", [FAILING + "spark.stop()", "raise SystemExit(print('FILES 1'))"])
def test_nothing_is_left_when_the_application_ends(scratch, more):
    script = SCRIPT.format(repo=REPO, folder=scratch, sf=SF, more=more)
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=300).stdout
    assert int(out.split("FILES ")[1].split()[0]) > 0
    assert [f for _, _, files in os.walk(scratch) for f in files] == []
