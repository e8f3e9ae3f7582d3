"""Every query with SQL against DuckDB on the smallest tables, and the contract of the entry module."""

import math
import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entry  # noqa: E402

QUERIES, SQL = entry.queries(), entry.oracle_sql()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, name):
    got = QUERIES[name](spark, str(DATA))
    want = con.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    order = sorted(names)
    a = sorted((tuple(plain(r[c]) for c in order) for r in got.collect()), key=repr)
    b = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in want.fetchall()), key=repr)
    assert a == b


def test_contract(spark):
    assert set(SQL) <= set(QUERIES)
    assert {f"p{n}_found" for n in (1, 2, 3, 4)} <= set(QUERIES)
    assert entry.entry(spark).count() > 0


def test_core_stands_without_llm():
    code = "import sys; sys.modules['foliant.llm'] = None\nimport __spark_entry__ as e\nassert 'p4_found' in e.queries() and 'p8_found' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
