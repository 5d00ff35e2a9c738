"""Every registered query against its DuckDB statement on sf0.001."""

import math
from datetime import datetime
from decimal import Decimal

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as E  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, Decimal):
        return v.normalize()
    if isinstance(v, datetime):
        return v.replace(tzinfo=None)
    return v


_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
          "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE"}


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple(map(repr, t)))


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, sf_small, con, name):
    sql = E.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL form: tested against a plain version elsewhere")
    df = E.queries()[name](spark, sf_small)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    stypes = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
              for f in df.schema.fields}
    assert stypes == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert _rows(df.columns, s_rows) == _rows(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["user_name", "queries", "gb", "cost_usd"]
