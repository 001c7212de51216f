"""The contract module without its optional part."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CHECK = """
import __spark_entry__ as entry
assert {'flow_table', 'csv_records'} <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
assert not [q for q in entry.queries() if q.startswith('op') and q[2:3].isdigit()] and 'pipeline' not in entry.queries()
"""


def test_imports_without_the_optional_part(tmp_path):
    """Also where only the subpackage is gone and the pipeline's module is left behind."""
    copy = tmp_path / "copy"
    shutil.copytree(os.path.join(ROOT, "tidewire"), copy / "tidewire", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(os.path.join(ROOT, name)):
            shutil.copy(os.path.join(ROOT, name), copy)
    for _ in range(2):
        done = subprocess.run([sys.executable, "-c", CHECK], cwd=copy, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
