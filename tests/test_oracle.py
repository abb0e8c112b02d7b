"""Every query with SQL against DuckDB on the same tables."""

import decimal
import math

import duckdb
import pytest

from newsloom.plans.queries import QUERIES
from newsloom.plans.sql import SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "None" if math.isnan(v) else repr(v + 0.0 if v else 0.0)
    return repr(float(v)) if isinstance(v, decimal.Decimal) else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    found = duck.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    want = sorted([plain(dict(zip(columns, row, strict=True))[c]) for c in order] for row in found.fetchall())
    got = sorted([plain(r[c]) for c in order] for r in df.collect())
    assert got == want


def test_every_query_has_sql_or_a_test_of_its_own():
    assert set(QUERIES) - set(SQL) == {"near_dup_groups", "factor_dedup", "topic_clusters", "entity_enrichment", "topics_merged", "near_dup_approximate", "near_dup_spread", "density_topics"}
