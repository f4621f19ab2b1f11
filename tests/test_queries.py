"""Every registered query against its SQL, on the smallest tables."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry  # noqa: E402

from partnerscope.plans import oracle, queries  # noqa: E402

duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
QUERIES, SQL = queries.REGISTRY, oracle.oracle()


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def ordered(rows):
    def plain(value):
        return round(value, 9) if isinstance(value, float) else value

    return sorted((tuple(plain(v) for v in r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_without_the_corpus_operators(tmp_path):
    """The entry is as good without that subpackage and its pipeline."""
    root = Path(__file__).resolve().parents[1]
    skipped = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "tests")
    shutil.copytree(root, tmp_path / "repo", ignore=skipped)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True)
    assert said.stdout.split() == [str(len(QUERIES)), str(len(SQL))], said.stderr


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, folder, database, name):
    made = QUERIES[name](spark, folder)
    columns = sorted(made.columns)
    found = ordered(made.select(*[f"`{c}`" for c in columns]).collect())
    database.execute(SQL[name])
    names = [d[0] for d in database.description]
    expected = [tuple(dict(zip(names, r))[c] for c in columns) for r in database.fetchall()]
    assert sorted(names) == columns
    assert found == ordered(expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"drop_tables", "catalog_columns"}))
def test_no_python_and_no_cross_join(spark, folder, name):
    text = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_entry(spark):
    assert entry.entry(spark).count() == 14
