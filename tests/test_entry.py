"""The entry file with and without the training-data part."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("gone", [["bidlake/llm", "tests/llm"], ["bidlake/llm", "tests/llm", "corpus_pipeline.py"]])
def test_rest_stands_alone(tmp_path, gone):
    """Without the subpackage the entry file imports, has the other queries, and the tests can be collected."""
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", "spark-warehouse"))
    for name in gone:
        path = tmp_path / "repo" / name
        if path.is_dir():
            shutil.rmtree(path)
        elif path.exists():
            path.unlink()
    code = "import __spark_entry__ as e; q = e.queries(); assert 'clean' in q and 'pipeline' not in q and not any(n.startswith('op1_') for n in q); e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    for args in (["-c", code], ["-m", "pytest", "tests", "-q", "--collect-only"]):
        done = subprocess.run([sys.executable, "-B", *args], cwd=tmp_path / "repo", env=env, capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stdout[-2000:] + done.stderr[-2000:]
