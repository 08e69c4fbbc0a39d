"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from kbetl.plans.oracles import ORACLES
from kbetl.plans.queries import REGISTRY

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
VIEWS = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for view in VIEWS.split():
        con.execute(f"create view {view} as select * from '{SF}/{view}.parquet'")
    return con


def normal(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 6)
        return v

    out = [tuple(value(row[i]) for i in order) for row in data]
    return sorted(columns), sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_every_query_has_sql():
    assert REGISTRY.keys() == ORACLES.keys()
    assert contract.queries().keys() >= REGISTRY.keys()


@pytest.mark.parametrize("name", REGISTRY)
def test_query_equals_sql(spark, sql, name):
    df = contract.queries()[name](spark, SF)
    cursor = sql.execute(contract.oracle_sql()[name])
    want = normal([c[0] for c in cursor.description], cursor.fetchall())
    assert normal(df.columns, df.collect()) == want


def test_entry(spark):
    assert contract.entry(spark).count() > 0
