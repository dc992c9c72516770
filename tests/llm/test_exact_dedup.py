import hashlib
import re

import duckdb

from ratelens.llm import exact_dedup, queries


def brute(rows):
    norm = [(k, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for k, t in rows]
    groups = {}
    for k, t in norm:
        groups.setdefault(t, []).append(k)
    out = []
    for k, t in norm:
        keep = min((x for x in groups[t] if x is not None), default=None)
        out.append((k, keep, len(groups[t]), k == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(5, "a  b"), (3, "a\tb"), (9, "a b"), (4, "a b "), (7, None), (6, ""), (8, " "), (2, "A b"), (None, "a b"), (None, "only null"),
        (11, "twice"), (11, "twice"), (12, "é x"), (13, "é x"), (14, "x" * 300000), (15, "x" * 300000)]


def test_equals_brute_force_for_any_split(spark):
    for parts, salts in ((1, 16), (7, 2), (16, 1)):
        df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(parts)
        assert sorted((tuple(r) for r in exact_dedup.dedup(df, salts=salts).collect()), key=str) == brute(ROWS)


def test_hot_text(spark):
    rows = [(i, "same text") for i in range(3000)] + [(10000 + i, f"text {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    assert sorted((tuple(r) for r in exact_dedup.dedup(df).collect()), key=str) == brute(rows)


def test_drop_copies_empty_and_clashing_columns(spark):
    df = spark.createDataFrame([(2, "a", 1, "x"), (1, "a", 2, "y"), (None, "a", 3, "z"), (4, "b", 4, "w")],
                               "doc_id long, text string, n int, digest string")
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    assert sorted((tuple(r) for r in kept.collect()), key=str) == [(1, "a", 2, "y"), (4, "b", 4, "w"), (None, "a", 3, "z")]
    assert exact_dedup.dedup(df.where("false")).collect() == []


def test_drop_copies_decides_by_row(spark):
    rows = [(5, "a", 1), (3, "a", 2), (5, "only here", 3), (7, "twice", 5), (7, "twice", 4), (7, "twice ", 6), (8, "b  c", 7), (8, "b c", 8),
            (None, "null id", 9), (None, "null id", 10), (0, "null id too", 11), (None, "", 12), (0, None, 13)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(5)
    got = exact_dedup.drop_copies(df)
    assert sorted(r.n for r in got.collect()) == [2, 3, 4, 6, 7, 9, 11, 12, 13]
    assert got.schema == df.schema


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    got = sorted(tuple(r) for r in queries.op8_exact_dedup(spark, sf).collect())
    assert got == sorted(con.execute(queries.ORACLE["op8_exact_dedup"]).fetchall())
