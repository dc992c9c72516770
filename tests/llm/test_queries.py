"""The registered queries: names, contract columns and types, SQL."""
import duckdb
import pytest

import __spark_entry__ as E
from ratelens.llm import queries

SF = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op2_": "query_id bigint, rank int, vec_id bigint, score double",
    "op3_": "doc_id bigint, held_out boolean, score double, predicted int",
    "op4_": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op5_": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op6_": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op7_": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op8_": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    "op9_": "conv_id bigint, turn bigint, role string",
    "op10_": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op11_": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op12_": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    "op13_": "word string, n bigint, n_near bigint, form string, form_n bigint, root string",
}


def named(prefix):
    [name] = [n for n in queries.QUERIES if n.startswith(prefix)]
    return name


def test_all_are_registered():
    assert {named(p) for p in CONTRACT} | {"pipeline"} <= set(E.queries())
    assert set(queries.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("prefix", sorted(CONTRACT))
def test_contract_columns(spark, prefix):
    types = dict(queries.QUERIES[named(prefix)](spark, SF).dtypes)
    for column in CONTRACT[prefix].split(", "):
        name, kind = column.split(" ")
        assert types[name] == kind, column


def test_one_row_per_document(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for prefix in ("op3_", "op4_", "op6_", "op8_", "op11_", "op12_"):
        out = queries.QUERIES[named(prefix)](spark, SF)
        assert out.count() == out.select("doc_id").distinct().count() == n


def test_quotation_linking_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    got = sorted(tuple(r) for r in queries.op9_quotation_linking(spark, SF).collect())
    assert got == sorted(con.execute(queries.ORACLE["op9_quotation_linking"]).fetchall())


def test_neighbours_of_the_table(spark):
    from test_hash_index import brute
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute(rows, lambda i: i % 20 == 0, 20)
    got = {}
    for r in queries.op2_hash_index(spark, SF).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert sum(len(got[q] & {i for i, _ in want[q]}) for q in want) >= 0.9 * 20 * len(want)


def test_leftovers_are_listed_and_deleted(spark):
    from ratelens.llm import common
    kept = common.written(spark.range(5).toDF("id"), "left")
    assert kept.count() == 5 and common.LEFT
    path = common.LEFT[-1]
    assert common.exists(spark, path)
    common.clear_leftovers(spark)
    assert not common.LEFT and not common.exists(spark, path)
