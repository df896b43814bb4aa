"""Every registered query against its SQL, at the smallest scale."""

import math
import os
import time
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as contract
from ebbtide.plans.oracles import ORACLES
from ebbtide.plans.queries import QUERIES

SF_DIR = os.environ.get("EBBTIDE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type -> types that SQL may give for it.
SAME_TYPE = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "timestamp_ntz": {"TIMESTAMP"},
    "boolean": {"BOOLEAN"},
}


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime):
        return value.isoformat(timespec="microseconds")
    return str(value)


def test_names_agree():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sql, name):
    start = time.time()
    got = contract.queries()[name](spark, SF_DIR)
    columns = sorted(got.columns)
    rows = sorted(tuple(map(normal, r)) for r in got.select(*columns).collect())
    print(f"{name}: {time.time() - start:.2f} s, {len(rows)} rows")
    relation = sql.sql(contract.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    types = dict(zip(relation.columns, map(str, relation.types)))
    for field in got.schema:
        assert types[field.name] in SAME_TYPE[field.dataType.simpleString()], field
    expected = relation.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    assert rows == sorted(tuple(map(normal, r)) for r in expected)
