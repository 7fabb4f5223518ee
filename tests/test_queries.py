"""Every registered query runs; those with SQL give the same rows as DuckDB. Fitted ones meet invariants."""

import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck
from checks.registry import QUERIES, SQL

SLOW = {"train_booster", "compare_models", "compared_errors", "compared_importances", "leak_ablation"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, sf_dir, name):
    result = compare(spark, con, name, QUERIES[name], SQL[name], sf_dir)
    assert result.startswith("ok"), result


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_query_runs(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    assert rows
    for r in rows:
        d = r.asDict()
        for metric in ("accuracy", "precision", "recall", "f1", "roc_auc", "share"):
            if d.get(metric) is not None:
                assert 0 <= d[metric] <= 1


def test_names_match():
    assert set(SQL) <= set(QUERIES)
    assert not any(n.startswith("op") and n[2:3].isdigit() or "pipeline" in n for n in QUERIES)
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("left_out", [("urlsieve/llm",), ("urlsieve/llm", "corpus_pipeline.py")])
def test_stands_alone(tmp_path, left_out):
    """A copy without the optional subpackage, with and without the pipeline, registers exactly the other queries."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    gone = [os.path.join(root, n) for n in left_out]
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=lambda d, names: [n for n in names if n in (".git", "tests", "__pycache__") or os.path.join(d, n) in gone])
    code = "import __spark_entry__ as e, checks.registry as r; assert e.queries() == r.QUERIES and e.oracle_sql() == r.SQL; print(e.__file__)"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True, text=True)
    assert out.returncode == 0 and out.stdout.strip().startswith(str(copy)), out.stderr


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 50 and len(df.columns) == 46
