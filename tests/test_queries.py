"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import math
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from strandline.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = catalogue.load()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def shown(value):
    if value is None or value is pd.NA or value is pd.NaT or isinstance(value, float) and math.isnan(value):
        return "NULL"
    if isinstance(value, float):
        return str(int(value)) if value == int(value) else f"{value:.6f}"
    return str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    rows = sorted(tuple(shown(v) for v in r) for r in frame.select(*columns).toPandas().itertuples(index=False))
    expected = duck.execute(ORACLES[name]).df()
    assert columns == sorted(expected.columns)
    assert rows == sorted(tuple(shown(v) for v in r) for r in expected[columns].itertuples(index=False))


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("pipeline_too", [True, False])
def test_the_rest_works_without_the_corpus_operators(tmp_path, pipeline_too):
    root = Path(__file__).parent.parent
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__"))
    for folder in ("strandline/llm", "tests/llm"):
        shutil.rmtree(copy / folder, ignore_errors=True)
    if pipeline_too:
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    code = "import __spark_entry__ as e; from strandline.plans import catalogue as c; q, o = c.load(); assert e.queries().keys() == q.keys() and e.oracle_sql() == o"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)
