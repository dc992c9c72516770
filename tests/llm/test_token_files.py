import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from ratelens.llm import token_files as T
from test_packing import ODD, expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=700))
def test_block_round_trip(values):
    ids = np.array(values, np.uint32)
    assert T.decode_block(T.encode_block(ids)).tolist() == values


def test_frequent_ids_take_one_byte():
    ids = np.concatenate([np.repeat(np.arange(60000, 60200), 50), np.arange(40000)])
    block = T.encode_block(ids)
    n_table = len(np.unique(ids))
    data = len(block) - T.HEADER.size - 4 * n_table - -(-len(ids) // 4)
    assert data == 256 + 49 * 200 + 2 * (len(ids) - 256 - 49 * 200)


def test_lengths_of_three_and_four_bytes():
    ids = np.arange(70000, dtype=np.uint32) * 7
    assert (T.decode_block(T.encode_block(ids)) == ids).all()


@pytest.mark.parametrize("block_tokens", [1, 50, 1 << 20])
def test_files_round_trip_in_id_order(spark, tmp_path, block_tokens):
    rows = ODD + [(1000 - i, "word %d " % i * (i % 9)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    T.write_token_files(df, str(tmp_path / "f"), block_tokens=block_tokens)
    got = sorted(T.read_token_files(spark, str(tmp_path / "f")).collect(), key=lambda r: r.start)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for r, (k, text) in zip(got, order, strict=True):
        ids = expected(text, 2)
        assert (r.doc_id, r.start, r.n_tokens) == (k, at, len(ids))
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids
        at += len(ids)


def test_documents_digests(spark, tmp_path):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    T.write_token_files(df, str(tmp_path / "f"))
    got = {r.doc_id: r for r in T.digest_columns(T.read_token_files(spark, str(tmp_path / "f"))).collect()}
    at = 0
    for r in sorted(df.select("doc_id", "text").collect(), key=lambda r: r.doc_id):
        ids = expected(r.text, 2)
        assert tuple(got[r.doc_id]) == (r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_empty_table_and_further_columns(spark, tmp_path):
    T.write_token_files(spark.createDataFrame([], "doc_id long, text string"), str(tmp_path / "a"))
    assert T.read_token_files(spark, str(tmp_path / "a")).collect() == []
    df = spark.createDataFrame([(1, "a", 4, 5)], "doc_id long, text string, shard int, base int")
    T.write_token_files(df, str(tmp_path / "b"))
    assert [(r.doc_id, r.start) for r in T.read_token_files(spark, str(tmp_path / "b")).collect()] == [(1, 0)]
