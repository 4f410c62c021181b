"""The entry file without the subpackage of training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def names(folder):
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); print(set(e.oracle_sql()) <= set(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True).stdout
    listed, known = out.splitlines()[-2:]
    assert known == "True"
    return set(listed.split())


def test_the_rest_works_without_the_subpackage(tmp_path):
    whole = names(ROOT) if (ROOT / "passagemill" / "llm").exists() else set()
    for kept in ("corpus_pipeline.py", ""):
        copy = tmp_path / (kept or "none")
        shutil.copytree(ROOT / "passagemill", copy / "passagemill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
        shutil.copy(ROOT / "__spark_entry__.py", copy)
        if kept and (ROOT / kept).exists():
            shutil.copy(ROOT / kept, copy)
        left = names(copy)
        assert left and not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in left)
        assert left <= whole or not whole
