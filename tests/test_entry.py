"""Driver contract: every registered query runs on sf0.001 and has a stable schema."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "Proximal LAD" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_runs(spark, name):
    df = E.queries()[name](spark, SF)
    schema1 = df.schema
    n = df.count()
    assert n >= 0
    assert E.queries()[name](spark, SF).schema == schema1


@pytest.mark.parametrize("gone", [("harmonia/llm", "corpus_pipeline.py"), ("harmonia/llm",), ("corpus_pipeline.py",)])
def test_entry_imports_without_the_training_data_operators(tmp_path, gone):
    repo = Path(E.__file__).parent
    shutil.copytree(repo / "harmonia", tmp_path / "harmonia", ignore=shutil.ignore_patterns("__pycache__", *(["llm"] if "harmonia/llm" in gone else [])))
    for name in {"__spark_entry__.py", "corpus_pipeline.py"} - set(gone):
        shutil.copy(repo / name, tmp_path / name)
    code = "import __spark_entry__ as E; q = E.queries(); print('pipeline' in q, any(n.startswith('op') for n in q), 'q_lesion_pivot' in q)"
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert got.stdout.split() == ["False", str("harmonia/llm" not in gone), "True"], got.stderr
