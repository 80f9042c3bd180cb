"""Every registered query against its SQL on the given tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract
from workload import oracle, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def canonical(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        if isinstance(v, Decimal):
            v = float(v)
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted(repr([plain(r[i]) for i in order]) for r in records)


def test_every_query_has_an_oracle():
    assert set(queries.queries()) == set(oracle.oracle_sql())
    assert set(queries.queries()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, duck, name):
    df = queries.queries()[name](spark, SF_DIR)
    found = duck.execute(oracle.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    types = {d[0]: str(d[1]) for d in found.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    assert canonical(df.collect(), df.columns) == canonical(found.fetchall(), columns)


ORDERED = (
    "bronze_price_dist",
    "bronze_rarity_dist",
    "gold_last6_months",
    "gold_top10_players",
    "gold_top10_skins",
    "prep_lowest_prices",
    "prep_top_prices",
    "quarantine_share",
    "rejection_reasons",
)


@pytest.mark.parametrize("name", ORDERED)
def test_reports_come_in_order(spark, duck, name):
    df = queries.queries()[name](spark, SF_DIR)
    found = duck.execute(oracle.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    want = [canonical([r], columns) for r in found.fetchall()]
    assert [canonical([r], df.columns) for r in df.collect()] == want


def test_entry(spark):
    assert contract.entry(spark).count() > 0
