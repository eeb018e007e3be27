"""Every registered query of the lending pipeline against its SQL on the smallest tables."""

import datetime
from decimal import Decimal

import duckdb
import pytest

from lendloom.plans import catalogue, raw_catalogue, stored_catalogue

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE_SQL = catalogue.QUERIES | raw_catalogue.QUERIES | stored_catalogue.QUERIES, catalogue.ORACLE_SQL | raw_catalogue.ORACLE_SQL | stored_catalogue.ORACLE_SQL
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(x):
    if isinstance(x, float | Decimal):
        return f"{float(x):.9g}"
    if isinstance(x, datetime.date | datetime.datetime):
        return x.isoformat()
    return str(x)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_gives_what_its_sql_gives(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = duck.sql(ORACLE_SQL[name])
    assert rows_of(df.columns, df.collect()) == rows_of(found.columns, found.fetchall())
