"""The rest of the package without the operators for training data."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def known(root):
    say = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    return [set(line.split()) for line in subprocess.run([sys.executable, "-c", say], cwd=root, check=True, capture_output=True, text=True).stdout.splitlines()]


def test_queries_without_the_two_folders(tmp_path):
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache")
    shutil.copytree(ROOT, tmp_path / "rest", ignore=left_out)
    queries, sql = known(tmp_path / "rest")
    assert "annual_release" in queries and "pipeline" not in queries and not any(q.startswith("op") for q in queries)
    assert sql == queries
    # and without the pipeline's file as well
    shutil.copytree(tmp_path / "rest", tmp_path / "less", ignore=shutil.ignore_patterns("corpus_pipeline.py"))
    assert known(tmp_path / "less")[0] == queries


def test_nothing_else_imports_the_two_folders():
    for source in [*ROOT.glob("noctule/**/*.py"), *ROOT.glob("tests/*.py")]:
        if "llm" not in source.relative_to(ROOT).parts and source.name != Path(__file__).name:
            assert "noctule.llm" not in source.read_text() and "from .llm" not in source.read_text(), source
