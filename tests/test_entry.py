"""The library without its optional part."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

IMPORT = """
import __spark_entry__ as E
from nestdoc import catalog
assert set(E.queries()) == set(catalog.QUERIES) == set(E.oracle_sql())
import bench
import tests.test_oracle
"""


@pytest.mark.parametrize("left", ["nothing", "empty folder", "pipeline file"])
def test_imports_without_the_training_data_part(tmp_path, left):
    copy = tmp_path / "repo"
    skip = shutil.ignore_patterns(".git", "__pycache__", "llm")
    shutil.copytree(REPO, copy, ignore=skip)
    if left != "pipeline file":
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    if left == "empty folder":
        (copy / "nestdoc" / "llm").mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", IMPORT], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
