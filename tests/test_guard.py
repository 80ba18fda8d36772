"""The engine works when the text operators' folder and the pipeline are gone."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("gone", [["adlake/llm", "tests/llm"], ["adlake/llm", "tests/llm", "corpus_pipeline.py"]])
def test_entry_without_text_operators(tmp_path, gone):
    shutil.copytree(ROOT, tmp_path, dirs_exist_ok=True, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for name in gone:
        shutil.rmtree(tmp_path / name) if (tmp_path / name).is_dir() else (tmp_path / name).unlink()
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q) == len(e.registry.QUERIES), set(e.oracle_sql()) <= set(q), any(k.startswith('op1_') or k == 'pipeline' for k in q))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120, env=env)
    assert out.stdout.split() == ["True", "True", "False"], out.stderr


def test_a_fault_within_the_operators_is_an_error(tmp_path):
    shutil.copytree(ROOT / "adlake", tmp_path / "adlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "adlake" / "llm").mkdir()
    (tmp_path / "adlake" / "llm" / "__init__.py").write_text("")
    (tmp_path / "adlake" / "llm" / "queries.py").write_text("import no_such_module")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, capture_output=True, text=True, timeout=120, env=env)
    assert out.returncode and "no_such_module" in out.stderr
