"""The driver's contract, and that the library and its entry stand without the llm subpackage and the pipeline."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["page_id", "stem", "title", "md", "n_chars"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_without_llm(tmp_path):
    shutil.copytree(ROOT / "docloom", tmp_path / "docloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)


def test_nothing_imports_llm():
    for path in (ROOT / "docloom").rglob("*.py"):
        if "llm" not in path.parts:
            assert "docloom.llm" not in path.read_text() and "from .llm" not in path.read_text(), path
