"""The entry must import where the corpus operators, or one of their libraries, are missing."""

import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
sys.modules[{name!r}] = None  # importing it fails
import __spark_entry__ as entry
print(sum(n.startswith("op") and n[2].isdigit() for n in entry.queries()), len(entry.queries()) > 100, len(entry.oracle_sql()) > 100)
"""


@pytest.mark.parametrize("name", ["ahocorasick", "xxhash", "corpus_pipeline", "gradus.llm"])
def test_without(tmp_path, name):
    script = SCRIPT.format(repo=str(REPO), name=name)
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.stdout.split() == ["0", "True", "True"], done.stderr[-2000:]
    assert "no corpus operators" in done.stderr
