"""The rest of the repository without the llm subpackage."""

import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("pipeline_left", [False, True])
def test_rest_stands_without_llm(tmp_path, pipeline_left):
    copy = tmp_path / "repo"
    gone = shutil.ignore_patterns(".git", "__pycache__", "llm", *([] if pipeline_left else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, copy, ignore=gone)
    (copy / "siltstone/llm/__pycache__").mkdir(parents=True)  # what a deletion may leave
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q) and len(q) > 90; assert not [n for n in q if n.startswith('op') and n[2:3].isdigit() or n == 'pipeline']"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})
    assert done.returncode == 0, done.stderr


def test_only_the_entry_knows_llm():
    if not (ROOT / "siltstone/llm").is_dir():
        return
    for file in (ROOT / "siltstone").rglob("*.py"):
        if "llm" not in file.relative_to(ROOT).parts:
            assert not re.search(r"^\s*(?:from|import)\s.*\bllm\b", file.read_text(), re.M), file
