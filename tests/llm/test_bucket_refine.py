"""Removal of repeated byte strings against brute force."""

import hashlib
import random
from collections import Counter

import pytest

from conftest import SF_SMALL
from ratelens.llm import bucket_refine
from ratelens.llm.queries import QUERIES

SCHEMA = "doc_id long, text string"
W = 200


def brute(rows):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[s:s + W] for _, b in texts for s in range(len(b) - W + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for s in range(len(b) - W + 1):
            if count[b[s:s + W]] > 1:
                gone[s:s + W] = b"\1" * W
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def noise(rng, n):
    return "".join(rng.choice("abcdefgh é\n") for _ in range(n))


def made(rng):
    """Texts that share passages of lengths around the limit, at all kinds of places."""
    shared = [noise(rng, n) for n in (150, 180, 190, 199, 200, 201, 230, 320, 900)]
    rows = []
    for i in range(120):
        text = noise(rng, rng.randrange(0, 400))
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(shared)
            cut = rng.randrange(0, 40)
            text += p[cut if rng.random() < .3 else 0:] + noise(rng, rng.randrange(0, 300))
        rows.append((i, text))
    return rows


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_bucket_refinement"](spark, SF_SMALL)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint",
                                "kept_sha256": "string"}
    want = brute([tuple(r) for r in docs])
    assert found(got) == want
    assert any(r[2] for r in want) and any(0 < r[2] < r[1] for r in want)


@pytest.mark.parametrize("hot", [20_000, 3])
def test_shared_passages(spark, monkeypatch, hot):
    monkeypatch.setattr(bucket_refine, "HOT", hot)  # 3: most buckets take the way of hot ones
    rows = made(random.Random(hot)) + [(1000 + i, "z" * (190 + i)) for i in range(15)]
    assert found(bucket_refine.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(6))) == brute(rows)


def test_copies_nulls_and_clashing_columns(spark):
    rng = random.Random(4)
    a, b = noise(rng, 500), noise(rng, 150)
    rows = [(1, a), (2, a), (2, a), (None, a), (3, b), (4, b), (5, None), (None, ""), (6, "x" + a[100:400] + "y"), (7, "ab" * 300),
            (8, "q" * 200), (9, "q" * 199), (10, "r" * 201)]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA + ", key string, n int")
    df = df.withColumnRenamed("key", "digest")
    assert found(bucket_refine.remove_repeats(df)) == brute(rows)


def test_long_texts_come_in_slices(spark, monkeypatch):
    rng = random.Random(9)
    p = noise(rng, 3000)
    rows = [(1, noise(rng, 9000) + p + noise(rng, 5000)), (2, p[:2000]), (3, noise(rng, 100) + p[1500:] + noise(rng, 4000)), (4, "a" * 9000)]
    monkeypatch.setattr(bucket_refine, "SLICE", 1024)
    assert found(bucket_refine.remove_repeats(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_a_very_long_text(spark):
    rng = random.Random(2)
    p = noise(rng, 700)
    text = "".join(rng.choices("abcdefgh", k=1_500_000))
    rows = [(1, text[:1_048_400] + p + text[1_048_400:]), (2, p), (3, " " * 1_300_000)]
    got = {r[0]: r[1:] for r in found(bucket_refine.remove_repeats(spark.createDataFrame(rows, SCHEMA)))}
    n = len(p.encode())
    assert got[1] == (len(rows[0][1].encode()), n, 1, hashlib.sha256(text.encode()).hexdigest())
    assert got[2][:3] == (n, n, 1) and got[3][:3] == (1_300_000, 1_300_000, 1)


def test_empty_table(spark):
    assert bucket_refine.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
