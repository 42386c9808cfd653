"""Layer 1: every registered query equals its independent SQL (DuckDB), and
returns rows, at sf0.01.  The training-data queries have tests of their own."""
import hashlib

import duckdb
import pytest

import __spark_entry__ as E
from rfmlens.functions.columns import decimals_to_double
from rfmlens.plans.registry import REGISTRY, queries
from rfmlens.sources.fixtures import Tables

SF = "/root/testdata/sf0.01"

RAW = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
KEYS = sorted(queries())


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def _norm(v):
    return "NULL" if v is None else (repr(v) if isinstance(v, float) else str(v))


def _digest(rows):
    hs = sorted(hashlib.md5("|".join(map(_norm, r)).encode()).hexdigest() for r in rows)
    return hashlib.md5("".join(hs).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in RAW:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(KEYS) <= set(E.queries()) and set(KEYS) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def tables(spark):
    """One set of tables, so that keys share what they have in common."""
    return Tables(spark, SF)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql(tables, duck, key):
    df = decimals_to_double(REGISTRY[key](tables))
    cols = sorted(df.columns)
    srows = [tuple(r[c] for c in cols) for r in df.collect()]
    rel = duck.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in rel.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    orows = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    otypes = dict(zip(ocols, [str(t) for t in duck.sql(E.oracle_sql()[key]).types]))
    for f in df.schema.fields:
        assert SPARK_TO_DUCK[f.dataType.simpleString()] == otypes[f.name], f.name
    assert len(srows) == len(orows) > 0
    assert _digest(srows) == _digest(orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "level" in df.columns
