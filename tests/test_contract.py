"""The driver contract of __spark_entry__.py."""

import re

import __spark_entry__ as E
from ratelens.plans.catalog import QUERIES
from ratelens.plans.oracle import ORACLE
from conftest import SF_SMALL


def test_entry_schema_is_stable(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema
    assert a.schema.simpleString() == "struct<movie_id:bigint,title:string,avg_rating:double,n:bigint>"


def test_entry_registers_the_catalog():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


def test_queries_and_oracles_pair_up():
    assert set(QUERIES) == set(ORACLE)
    assert all(callable(f) for f in QUERIES.values())
    assert all(isinstance(s, str) and s.strip() for s in ORACLE.values())


def test_output_columns_are_plain_aliases(spark):
    for name, fn in QUERIES.items():
        cols = fn(spark, SF_SMALL).columns
        assert cols and all(re.fullmatch(r"[a-z][a-z0-9_]*", c) for c in cols), (name, cols)
        assert len(set(cols)) == len(cols), (name, cols)
