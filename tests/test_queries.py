"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import math
import os
import subprocess
import sys

import duckdb
import pytest

from kinweave.plans import registered

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = registered()


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 5) + 0.0)
    return repr(v) if v is None or isinstance(v, str) else str(v)


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_same_rows(spark, sf, con, name):
    query, sql = QUERIES[name]
    df = query(spark, sf)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())


def test_entry_without_the_other_subpackage(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run(["cp", "-r", f"{root}/kinweave", f"{root}/__spark_entry__.py", str(tmp_path)], check=True)
    subprocess.run(["rm", "-r", str(tmp_path / "kinweave" / "llm")], check=False)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'cube_rollup' in q and 'pipeline' not in q and e.oracle_sql()"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": ""}, check=True)
