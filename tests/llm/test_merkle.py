"""Merkle manifest against a plain Merkle tree in Python."""

import hashlib
import zlib

import numpy as np
import pytest

from conftest import SF_SMALL
from ratelens.llm import merkle
from ratelens.llm.queries import QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """Levels of a tree, and each leaf's siblings level by level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i:i + 3]) for i in range(0, len(last), 3)])
    paths = []
    for i in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            a = i - i % 3
            path.append(("".join(level[a:i]), "".join(level[i + 1:a + 3])))
            i //= 3
        paths.append(path)
    return levels[-1][0], paths


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, H(*map(enc, r)), r))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    done = {s: tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in order}
    root, tops = tree([done[s][0] for s in order]) if order else (None, [])
    out = []
    for s, top in zip(order, tops):
        for (_, _, leaf, r), path in zip(sorted(by_source[s], key=lambda x: x[:3]), done[s][1]):
            path = path + top
            held = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None:
                held = H(*map(enc, (*r[:4], r[4].replace("\n", ""))))
            for left, right in path:
                held = H(left, held, right)
            out.append((r[0], leaf, done[s][0], root, H(*[a + b for a, b in path]), held, held == root))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
                   .collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()
    got = QUERIES["op12_merkle_manifest"](spark, SF_SMALL)
    want = brute([tuple(r) for r in docs])
    assert found(got) == want
    assert {w[-1] for w in want} == {True, False}


def test_sources_of_several_tiers_sparse_and_negative_ids(spark):
    rng = np.random.default_rng(5)
    ids = [int(i) for i in rng.integers(-2**62, 2**62, 60)] + list(range(65_000, 67_300)) + [2**63 - 1, -2**63, 0, -1]
    rows = [(i, "hot", "en", 3, f"a\n{i}") for i in ids] + [(i, f"s{i % 40}", None, None, "b") for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert found(merkle.manifest(df)) == brute(rows)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = ([(None, None, None, None, None)] * 3 + [(None, "a", "x", 1, f"t{i}") for i in range(5)]
            + [(7, "a", "x", 1, f"u\n{i}") for i in range(12)] + [(7, "a", "x", 1, "same\n")] * 4 + [(8, "a", None, 1, "")]
            + [(9, None, "x", 1, "é\n" * 200_000), (2, "é", "x", 1, "z"), (2, "z", "x", 1, "z"), (6, "", "", 0, "")])
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA + ", src string, idx int").repartition(3)
    assert found(merkle.manifest(df)) == brute(rows)


def test_a_repeated_id_is_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HOT", 50)
    rows = [(5, "a", "x", 1, f"t{i}") for i in range(300)] + [(i, "a", "x", 1, "v") for i in range(40)]
    assert found(merkle.manifest(spark.createDataFrame(rows, SCHEMA).repartition(4))) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_small_tables(spark, n):
    rows = [(i, f"s{i % 2}", "x", 1, "t\n") for i in range(n)]
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA))
    assert dict(got.dtypes) == {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string",
                                "proof_sha256": "string", "folded_root": "string", "verified": "boolean"}
    assert found(got) == brute(rows)


def test_bitmap_ranks():
    rng = np.random.default_rng(3)
    for size in (1, 100, 5000, 65536):
        low = np.sort(rng.choice(65536, size, replace=False))
        n = np.where(rng.random(size) < 0.2, 3, 1)
        ranks = merkle.Ranks(*merkle._counted(low, n))
        at, same = ranks.rank(low)
        assert (at == np.cumsum(n) - n).all() and (same == n).all()
