"""Driver contract: entry() smoke and every registered query against its oracle at sf0.001."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from labrelay.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["orders", "customer", "lineitem", "events"]
NAMES = sorted(QUERIES)


def norm(v):
    return None if v is None else str(v)


def bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["offset", "value"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.queries()) & set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = df.collect()
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert bag(df.columns, rows) == bag(rel.columns, rel.fetchall())


def test_entry_in_a_session_with_default_settings(spark):
    """The driver's session may leave spark.sql.shuffle.partitions unset."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.unset("spark.sql.shuffle.partitions")
    try:
        assert entry.entry(spark).count() > 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
