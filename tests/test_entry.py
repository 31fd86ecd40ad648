import os
import shutil
import subprocess
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import digest  # noqa: E402
from fieldbook.plans.tables import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["Product_ID", "Product_Name", "crops", "diseases", "pests", "n_crops", "n_diseases",
                          "n_pests"]


def test_oracle_keys_subset_of_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ref = cur.fetchall()
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(ref)
    assert digest(df.columns, got)[0] == digest(cols, ref)[0]


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_entry_without_the_optional_subpackage(tmp_path, with_pipeline):
    """The other queries stay when the subpackage's folders are not there, with its pipeline or without."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if with_pipeline else ["corpus_pipeline.py"]))
    copy = shutil.copytree(root, tmp_path / "copy", ignore=left_out)
    said = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, "
         "any(k.startswith('op') for k in q), set(e.oracle_sql()) <= set(q))"],
        cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    from fieldbook.plans import registry
    assert said.stdout.split() == [str(len(registry())), "False", "False", "True"]
