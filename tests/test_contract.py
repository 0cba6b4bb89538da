"""The driver's contract."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as e


def test_names():
    q, s = e.queries(), e.oracle_sql()
    assert set(s) <= set(q) and "p3_found" in q and "thread_flagship" in q


def test_core_stands_without_the_subpackage(tmp_path):
    """In a copy without the folder, the rest imports and registers its queries."""
    root = Path(e.__file__).resolve().parent
    shutil.copytree(root / "lettermill", tmp_path / "lettermill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import pkgutil, importlib, lettermill, __spark_entry__ as e; [importlib.import_module(m.name) for m in pkgutil.walk_packages(lettermill.__path__, 'lettermill.') if not m.name.endswith('__main__')]; print(*e.queries())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, check=True).stdout.split()
    assert "thread_ids" in said and "p3_found" in said and "p1_found" not in said
