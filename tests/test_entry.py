"""The driver entry, whole and without the corpus operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__

ROOT = Path(__file__).resolve().parents[1]
ASK = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), 'pipeline' in q, any(k.startswith('op1_') for k in q), set(o) <= set(q))"


def test_registered():
    queries, oracle = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracle) <= set(queries) and "interaction_totals" in queries


@pytest.mark.parametrize("gone", [("graphspark/llm", "tests/llm", "corpus_pipeline.py"), ("graphspark/llm", "tests/llm")])
def test_without_corpus_operators(tmp_path, gone):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for name in gone:
        path = tmp_path / "copy" / name
        shutil.rmtree(path) if path.is_dir() else path.unlink()
    out = subprocess.run([sys.executable, "-c", ASK], cwd=tmp_path / "copy", env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"}, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    n, pipeline, corpus, covered = out.stdout.split()
    assert int(n) > 100 and (pipeline, corpus, covered) == ("False", "False", "True")
