"""Driver contract: entry() runs, every query has a callable, oracles are a subset."""

from __future__ import annotations

import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["source", "step_number", "step_name", "sessions_reached",
                          "pct_of_funnel_start", "pct_of_previous_step"]
    assert df.count() >= 0


def test_catalogue_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 40


def test_entry_works_without_the_training_data_part(tmp_path):
    """The subpackage and the pipeline can be left out."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    shutil.copytree(os.path.join(root, "eventmarts"), tmp_path / "eventmarts",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                          env={**os.environ, "PYTHONPATH": str(tmp_path)}, timeout=120)
    assert done.returncode == 0, done.stderr
    left = [n for n in E.queries() if not n.startswith("op") and n != "pipeline"]
    assert done.stdout.split() == [str(len(left))] * 2
