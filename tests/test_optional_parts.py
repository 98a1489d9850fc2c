"""Without the training-data folders the rest imports, keeps its queries, and its tests can be collected."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_optional_folders(tmp_path):
    skip = shutil.ignore_patterns(".git", "llm", "__pycache__", "*.json", "spark-warehouse")
    copy = f"{tmp_path}/repo"
    shutil.copytree(ROOT, copy, ignore=skip)
    code = ("import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); "
            "assert len(q) >= 60 and set(o) <= set(q); assert not [k for k in q if k.startswith('op') or k == 'pipeline']")
    env = {**os.environ, "PYTHONPATH": copy}
    subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, check=True)
    found = subprocess.run([sys.executable, "-m", "pytest", "tests", "--collect-only", "-q", "-p", "no:cacheprovider"], cwd=copy, env=env, capture_output=True, text=True)
    assert found.returncode == 0, found.stdout + found.stderr
    assert "tests/test_oracles.py::" in found.stdout


def test_nothing_but_the_entry_and_the_pipeline_imports_the_optional_folder():
    for folder, dirs, names in os.walk(f"{ROOT}/curata"):
        dirs[:] = [d for d in dirs if d not in ("llm", "__pycache__")]
        for name in names:
            if name.endswith(".py"):
                with open(f"{folder}/{name}", encoding="utf-8") as f:
                    assert "curata.llm" not in f.read(), name
