"""Every registered query against its DuckDB oracle SQL (sf0.001).

The driver runs the same comparison at sf0.01; ``python
tests/oracle_compare.py /root/testdata/sf0.01`` reproduces it."""

import pytest

import __spark_entry__ as E
from ratelens.plans.catalog import QUERIES
from ratelens.plans.oracle import ORACLE
from conftest import SF_SMALL
from oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    assert info["cols_match"], info
    assert info["spark_rows"] == info["duck_rows"], info
    assert info["values_match"], info


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["movie_id", "title", "avg_rating", "n"]
    assert df.count() > 0


EDGE_TEXTS = [
    "ôi bao giờ bao bao lâu hôm nay, bao  giờ có", "Chúng tôi ở đây; có thể đã từng tại sao?",
    "bao nhiêu tiền hôm qua", "hômnay baogiờ bao-giờ", "là của và", "x là y", "", "một hai ba",
    "tốt!!  rất   tốt\t", "Ừm ừ ạ à ư ở nhé nha",
]


def test_cleaning_oracle_matches_spark_on_edge_texts(spark):
    import duckdb
    from pyspark.sql import functions as F
    from ratelens.functions.text import clean_review
    from ratelens.plans import oracle as O
    con = duckdb.connect()
    con.execute("create table pr (k integer, review varchar)")
    con.executemany("insert into pr values (?, ?)", list(enumerate(EDGE_TEXTS)))
    sql = (f"with runs as (select k, regexp_extract_all(lower(review), '[{O._WORD}]+|[^{O._WORD}]+') as l "
           f"from pr) select k, {O._CLEAN} from runs order by k")
    duck = [r[1] for r in con.execute(sql).fetchall()]
    df = spark.createDataFrame(list(enumerate(EDGE_TEXTS)), "k int, review string")
    sp = [r[0] for r in df.orderBy("k").select(clean_review(F.col("review"))).collect()]
    assert sp == duck


def test_parse_oracle_matches_spark_on_edge_lines(spark):
    import duckdb
    from test_readers import EDGE_LINES
    from ratelens.plans import oracle as O
    from ratelens.sources.files import parse_review_lines
    lines = [e for e in EDGE_LINES if not e.startswith("id;")]
    con = duckdb.connect()
    con.execute("create table lines (line varchar)")
    con.executemany("insert into lines values (?)", [(e,) for e in lines])
    sql = (f"select try_cast(trunc(try_cast({O._ex(1)} as double)) as integer), {O._ex(2)}, {O._ex(3)}, "
           f"{O._ex(4)}, {O._ex(5)} from lines")
    duck = sorted(con.execute(sql).fetchall(), key=repr)
    df = spark.createDataFrame([(e,) for e in lines], "line string")
    sp = sorted((tuple(r) for r in parse_review_lines(df).collect()), key=repr)
    assert sp == duck  # including the id: '12.5' truncates to 12 on both sides


@pytest.mark.parametrize("name", ["year_mean", "ratings_union_all"])
def test_time_queries_ignore_session_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        info = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_SMALL)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert info["values_match"] and info["spark_rows"] == info["duck_rows"], info
