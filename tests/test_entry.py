"""The entry module, with and without the optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_entry_without_llm(tmp_path):
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    shutil.copytree(ROOT / "sampleprep", tmp_path / "sampleprep", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert o.keys() <= q.keys() and not [n for n in q if n.startswith('op') or n == 'pipeline']; print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) >= 45


def test_nothing_else_imports_llm():
    for path in (ROOT / "sampleprep").rglob("*.py"):
        if "llm" not in path.parts:
            assert "sampleprep.llm" not in path.read_text(), path
