"""Intermediate tables and checkpoints of the operators go when the application ends."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import os, sys
sys.path.insert(0, {repo!r})
from tillsight.session import build_session
spark = build_session("local[2]", 2, extra={{"spark.checkpoint.dir": {folder!r}}})
from tillsight.llm import near_dup
docs = spark.createDataFrame([(i, "one two three four five six" + " x" * (i % 3)) for i in range(20)], "doc_id long, text string")
near_dup.near_duplicates(docs, words=3, percent=85).count()
print("FILES", sum(len(f) for _, _, f in os.walk({folder!r})))
"""


def test_nothing_is_left_when_the_application_ends(scratch):
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO, folder=scratch)], capture_output=True, text=True, timeout=300).stdout
    assert int(out.split("FILES ")[1].split()[0]) > 0
    assert [f for _, _, files in os.walk(scratch) for f in files] == []
