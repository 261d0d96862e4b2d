"""Every registered query against its SQL, at the smallest scale."""

import glob
import os
import subprocess
import sys
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from rollbook.plans.registered import QUERIES, SQL

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("absent", ["zstandard", "corpus_pipeline", "rollbook.llm"])
def test_registry_queries_without_the_corpus_part(absent):
    """The entry imports where a package of the corpus part, or that part itself, is missing."""
    code = (f"import sys; sys.modules[{absent!r}] = None; import __spark_entry__ as e; "
            "print(sorted(e.queries()) == sorted(e.QUERIES))")
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=False,
                         cwd=os.path.dirname(os.path.abspath(entry.__file__)))
    assert run.stdout.strip().endswith("True"), run.stderr


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    want = Counter(repr(row) for row in result.fetchall())
    assert Counter(repr(tuple(row)) for row in df.select(*columns).collect()) == want
