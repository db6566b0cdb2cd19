"""The queries without the subpackage of the ten operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent
SAYS = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"


@pytest.mark.parametrize("pipeline", [True, False])
def test_deleting_the_ten_operators_leaves_the_rest(tmp_path, pipeline):
    for name in ("corpuskit", "tests", "__spark_entry__.py", *(["corpus_pipeline.py"] if pipeline else [])):
        whole = ROOT / name
        if whole.is_dir():
            shutil.copytree(whole, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        elif whole.exists():
            shutil.copy(whole, tmp_path / name)
    said = subprocess.run([sys.executable, "-B", "-c", SAYS], cwd=tmp_path, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    names, oracles = (line.split() for line in said.stdout.splitlines())
    assert len(names) >= 35 and not any(n.startswith("op") or n == "pipeline" for n in names) and set(oracles) <= set(names)
    listed = subprocess.run([sys.executable, "-B", "-m", "pytest", "--collect-only", "-q", "tests"], cwd=tmp_path, capture_output=True, text=True)
    assert listed.returncode == 0, listed.stdout
