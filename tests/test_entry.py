"""The registry without the training-data operators: everything else stays."""

import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from tenderline.plans.catalog import MORE, QUERIES

HERE = Path(__file__).resolve().parent.parent
SHOW = """
import json, sys
for name in sys.argv[1:]:
    sys.modules[name] = None
import __spark_entry__ as entry
print(json.dumps([sorted(entry.queries()), sorted(entry.oracle_sql())]))
"""


def registered(folder: Path, *gone: str):
    env = {**os.environ, "PYTHONPATH": str(folder), "PYTHONDONTWRITEBYTECODE": "1"}
    return subprocess.run([sys.executable, "-c", SHOW, *gone], cwd=folder, env=env, capture_output=True, text=True)


@pytest.mark.parametrize("gone", [(), ("public_tokenizers",)])
def test_plain_queries_stand_alone(tmp_path, gone):
    """Both llm folders are deleted, the pipeline's module is still there."""
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache")
    shutil.copytree(HERE, tmp_path / "repo", ignore=skip)
    (tmp_path / "repo" / "corpus_pipeline.py").write_text("from tenderline.llm.common import read_table\n")
    done = registered(tmp_path / "repo", *gone)
    assert done.returncode == 0, done.stderr
    assert json.loads(done.stdout) == [sorted(QUERIES | MORE), sorted(QUERIES | MORE)]


def test_other_missing_modules_are_told(tmp_path):
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache")
    shutil.copytree(HERE, tmp_path / "repo", ignore=skip)
    (tmp_path / "repo" / "tenderline" / "llm").mkdir()
    (tmp_path / "repo" / "tenderline" / "llm" / "__init__.py").touch()
    (tmp_path / "repo" / "tenderline" / "llm" / "queries.py").write_text("import no_such_module\n")
    assert "no_such_module" in registered(tmp_path / "repo").stderr
