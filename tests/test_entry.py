"""The catalogue's queries work when the folders of the corpus operators are not there."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_optional_parts(tmp_path):
    skipped = shutil.ignore_patterns("llm", ".git", "__pycache__", "*.json")
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=skipped)
    assert (copy / "corpus_pipeline.py").exists()
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') or n == 'pipeline' for n in q), set(e.oracle_sql()) <= set(q))"
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=environment, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    count, corpus, known = done.stdout.split()
    assert int(count) > 60 and corpus == "False" and known == "True"
