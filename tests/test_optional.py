"""The engine works without the training-data subpackage."""

import shutil
import subprocess
import sys

from tests.conftest import ROOT


def test_entry_without_the_optional_parts(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda d, names: [n for n in names if n in ("llm", "corpus_pipeline.py", ".git")])
    code = ("import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); "
            "assert 'reconcile_entries' in q and not any(n.startswith('op') or n == 'pipeline' for n in [*q, *o]); print(len(q))")
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True,
                          env={"PATH": "/usr/bin:/bin", "HOME": "/tmp"})
    assert done.returncode == 0, done.stderr[-2000:]
