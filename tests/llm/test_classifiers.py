import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelens.llm import language_id as L, quality as Y, queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_language_held_out(spark, documents):
    rows = queries.op1_language_id(spark, SF).collect()
    assert len(rows) == len(documents) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert 0.2 < len(held) / len(rows) < 0.3
    assert sum(r.lang_pred == documents[r.doc_id].lang for r in held) >= 0.97 * len(held)


def test_subwords_equal_a_plain_count():
    rng = random.Random(5)
    for _ in range(50):
        text = "".join(rng.choice("abÉß 1.-\n日") for _ in range(rng.randrange(40)))
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        want = [sum(len(w) if n == 1 else max(0, len(w) + 3 - n) for w in words) for n in range(1, L.WIDTHS + 1)]
        assert [len(b) for b, _ in L.subwords([text])] == want


def test_totals_do_not_depend_on_the_batch():
    rng = np.random.default_rng(1)
    model = L.Model(["a", "b"], rng.normal(size=(L.BUCKETS, 2)), np.zeros(2), 1.0, 0.5)
    texts = ["hello world", "", None, "ÉTÉ 12 x", "ß" * 30, "12 .."]
    total, number = L._totals(texts, model)
    for i, t in enumerate(texts):
        seen, counts = L.bag(t)
        assert number[i] == counts.sum()
        assert np.allclose(total[i], (model.scores[seen] * counts[:, None]).sum(0))


def test_language_odd_rows(spark, documents):
    some = [(i, r.text, r.lang) for i, r in documents.items()][:300]
    odd = [(5000, None, "en"), (5001, "", "en"), (5002, "12 34 !!", None), (None, "the that and", None), (5003, "the " * 400000, None),
           (5004, "x" * (L.PIECE + 10), None), (5005, "the", None), (5005, "the", None)]
    df = spark.createDataFrame([(*r, 1) for r in some + odd], "doc_id long, text string, lang string, score int")
    model = L.fit(df, F.col("doc_id") % 4 != 2)
    got = L.predict(df, model).collect()
    assert len(got) == len(some) + len(odd)
    by = {r.doc_id: r for r in got}
    assert [(by[i].lang_pred, by[i].score, by[i].rejected) for i in (5000, 5001, 5002)] == [("und", 0.0, True)] * 3
    assert by[None].lang_pred in model.classes and by[5003].lang_pred == "en" and by[5004].lang_pred in model.classes
    assert L.fit(df.where("false"), F.lit(True)) is None
    assert {r.lang_pred for r in L.predict(df, None).collect()} == {"und"}
    assert L.predict(df.where("false"), model).collect() == []


def test_quality_held_out(spark):
    rows = {r.doc_id: r for r in queries.op3_quality(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    held = [(rows[r.doc_id], r.quality) for r in labels if rows[r.doc_id].held_out]
    good, bad = [r.score for r, q in held if q == 1], [r.score for r, q in held if q == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc >= 0.95
    assert all(r.predicted == int(r.score >= 0.3) for r in rows.values())
    assert sum(s >= 0.3 for s in good) >= 0.95 * len(good) and sum(s < 0.3 for s in bad) >= 0.8 * len(bad)


def test_quality_does_not_depend_on_the_split(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    a = Y.score(docs, Y.fit(docs.repartition(1), labels, F.lit(True))).collect()
    b = Y.score(docs.repartition(5), Y.fit(docs.repartition(6), labels, F.lit(True))).collect()
    assert {r.doc_id: round(r.score, 9) for r in a} == {r.doc_id: round(r.score, 9) for r in b}


def test_contexts_equal_brute_force():
    docs = [b"The cat sat, on THE CAT", b"", b"no no no way!!", "é è".encode()]
    out = next(iter(Y._contexts(iter([__import__("pyarrow").record_batch({"text": [d.decode() for d in docs]})]))))
    got = np.zeros(Y.BUCKETS * Y.DIM, np.int64)
    import zlib
    for i, c in zip(out["chunk"].to_pylist(), out["counts"].to_pylist(), strict=True):
        got[i * (1 << 14):(i + 1) * (1 << 14)] = np.frombuffer(zlib.decompress(c), np.int64)
    want = np.zeros((Y.BUCKETS, Y.DIM), np.int64)
    bucket, first = Y.tokens(docs)
    assert np.diff(first).tolist() == [7, 0, 5, 2] and (bucket[5:7] == Y.CAPITALS).all() and (bucket[8:10] == Y.REPEAT).all()
    for a, z in zip(first[:-1], first[1:], strict=True):
        for i in range(a, z):
            for j in range(max(a, i - Y.REACH), min(z, i + Y.REACH + 1)):
                if i != j:
                    for p, s in zip(Y.PLACE[bucket[j]], Y.SIGN[bucket[j]], strict=True):
                        want[bucket[i], p] += int(s)
    assert (got.reshape(Y.BUCKETS, Y.DIM) == want).all()


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (2, "", 2), (None, "a b", 3), (3, "word " * 200000, 4), (4, "!!!", 5)],
                                 "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 1)], "doc_id long, quality int")
    got = Y.score(docs, Y.fit(docs, labels, F.lit(True))).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    none = Y.fit(docs.where("false"), labels.where("false"), F.lit(True))
    assert {r.score for r in Y.score(docs, none).collect()} == {0.5}
    kept = Y.keep_good(docs, none)
    assert kept.columns == docs.columns and kept.count() == 6
    assert Y.score(docs.where("false"), none).collect() == []
