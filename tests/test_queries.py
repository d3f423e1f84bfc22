"""Every query of the catalogue against its DuckDB SQL, on the smallest tables."""

import datetime
import decimal
import math
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from quantloom.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.isoformat()[:19]
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in ORACLES:
        assert got
        return
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(plain(row[names.index(c)]) for c in columns) for row in result.fetchall()), key=repr)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns == ["corp", "fy", "op_margin", "roe", "per", "pbr", "market_cap"]


def test_entry_without_the_training_data_package():
    """The entry module imports, and keeps its other queries, where the subpackage and the pipeline are gone."""
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "corpus_pipeline" or name.startswith("quantloom.llm"):
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
q = e.queries()
assert "o9_01_screen" in q and not any(k.startswith("op") or k == "pipeline" for k in q), sorted(q)
assert set(e.oracle_sql()) <= set(q)
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=entry.__file__.rsplit("/", 1)[0])


def test_oracles_have_queries():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 120
