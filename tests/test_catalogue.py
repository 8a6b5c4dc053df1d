"""Every query that has an SQL twin, against DuckDB on the smallest tables."""
import os

import pytest

from foliospark.plans import queries as P

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "conversations", "embeddings"):
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(P.ORACLES))
def test_query_matches_its_sql(spark, duck, name):
    df = P.QUERIES[name](spark, SF)
    cursor = duck.execute(P.ORACLES[name])
    names = [x[0] for x in cursor.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in names)) for r in df.collect())
    assert got == sorted(map(repr, cursor.fetchall())) and got


def test_the_catalogue_imports_without_a_session():
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert len(e.queries()) >= 50 and set(e.oracle_sql()) <= set(e.queries())"], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-500:]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
