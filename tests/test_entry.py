"""The entry file without the parts that can be left out."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n.startswith('op') for n in q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))"


def _copy(to, *left_out):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in left_out and os.path.exists(f"{ROOT}/{name}"):
            shutil.copy(f"{ROOT}/{name}", to)
    skip = shutil.ignore_patterns("__pycache__", *(n for n in left_out if n == "llm"))
    for name in ("trackspark", "checks"):
        shutil.copytree(f"{ROOT}/{name}", to / name, ignore=skip)


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py")])
def test_entry_imports_without_the_training_data_part(tmp_path, left_out):
    _copy(tmp_path, *left_out)
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", COUNT], cwd=tmp_path, capture_output=True, text=True, check=True,
                         env=os.environ | {"PYTHONPATH": ""})
    number, operators, pipeline, known = out.stdout.split()
    assert int(number) > 60 and (operators, pipeline, known) == ("False", "False", "True")


def test_entry_imports_when_one_package_is_missing(tmp_path):
    """A package that only the training-data part needs: the core queries stay."""
    _copy(tmp_path)
    (tmp_path / "zstandard.py").write_text("raise ImportError('not installed')")
    out = subprocess.run([sys.executable, "-W", "ignore", "-c", COUNT], cwd=tmp_path, capture_output=True, text=True, check=True,
                         env=os.environ | {"PYTHONPATH": ""})
    assert out.stdout.split()[1:3] == ["False", "False"]
