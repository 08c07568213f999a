"""The registry works with the subpackage for training data and the pipeline, and without them."""

import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_registry_without_llm(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.json"))
    for gone in (("splicedf", "llm"), ("tests", "llm")):
        shutil.rmtree(copy.joinpath(*gone), ignore_errors=True)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), len(o), any(x.startswith('op') for x in q), 'pipeline' in q)"
    for keep in (True, False):
        if not keep and (copy / "corpus_pipeline.py").exists():
            (copy / "corpus_pipeline.py").unlink()
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, capture_output=True, text=True, timeout=120)
        assert out.returncode == 0, out.stderr
        n, sql, op, pipeline = out.stdout.split()
        assert int(n) > 100 and int(sql) > 100 and (op, pipeline) == ("False", "False")
