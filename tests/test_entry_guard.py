"""The library without its training-data operators."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry_point
import pytest

ROOT = os.path.dirname(os.path.abspath(entry_point.__file__))


@pytest.mark.parametrize("gone", [{"llm"}, {"llm", "corpus_pipeline.py"}], ids=["folders", "folders and pipeline"])
def test_everything_else_works_without_them(tmp_path, gone):
    """The copy without the folders has all other queries, and its own tests can be collected."""

    def absent(folder, names):
        return [n for n in names if n in {".git", "__pycache__", ".pytest_cache"} or n in gone]

    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=absent)
    code = "import __spark_entry__ as e; print(*sorted(e.queries()), sep='\\n'); assert e.oracle_sql()"
    env = {**os.environ, "PYTHONPATH": str(copy)}
    run = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120, env=env)
    assert run.returncode == 0, run.stderr
    left = set(run.stdout.split())
    own = {n for n in entry_point.queries() if not (n.startswith("op") and n[2].isdigit()) and n != "pipeline"}
    assert left == own
    collect = [sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"]
    run = subprocess.run(collect, cwd=copy, capture_output=True, text=True, timeout=120, env=env)
    assert run.returncode == 0, run.stdout + run.stderr
    assert "test_query_equals_sql" in run.stdout and "sql[op" not in run.stdout and "tests/llm" not in run.stdout


def test_nothing_else_imports_them():
    for folder, _, names in os.walk(os.path.join(ROOT, "urnalake")):
        if os.path.basename(folder) == "llm":
            continue
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as file:
                    assert "urnalake.llm" not in file.read(), name
