"""Every registered query of the time-series engine against its DuckDB twin, on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from tidegauge.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def rows(df):
    df = df[sorted(df.columns)]
    one = lambda v: None if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v) else f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted((tuple(map(one, r)) for r in df.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_duckdb(spark, duck, name):
    got, want = registry.queries()[name](spark, SF).toPandas(), duck.execute(registry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(registry.queries().keys() - registry.oracle_sql().keys()))
def test_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0


def test_entry_imports_without_the_optional_parts():
    """With the subpackage out of reach the rest still imports."""
    code = (
        "import sys\n"
        "class No:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('tidegauge.llm', 'corpus_pipeline'): raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, No())\n"
        "import __spark_entry__ as e\n"
        "assert 'c05_lacks' in e.queries() and 'pipeline' not in e.queries() and not [n for n in e.queries() if n.startswith('op')]\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parent.parent)
