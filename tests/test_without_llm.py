"""The library stands without the training-data operators."""

import os
import re
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("gone", [("llm",), ("llm", "corpus_pipeline.py")])
def test_entry_works_without_them(tmp_path, gone):
    shutil.copytree(ROOT, tmp_path / "r", ignore=shutil.ignore_patterns(".git", "__pycache__", *gone))
    run = "from pyspark.sql import SparkSession; s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate(); assert e.entry(s).count() > 0"
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert q and set(q) == set(s), set(q) ^ set(s); assert not any(n.startswith('op') for n in q); " + run
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "r", env=env, check=True)


def test_nothing_else_imports_them():
    for folder, _, names in os.walk(os.path.join(ROOT, "quillspark")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf-8") as f:
                        assert not re.search(r"quillspark\.llm|from \.+llm|corpus_pipeline", f.read()), name
