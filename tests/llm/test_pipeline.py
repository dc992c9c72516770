"""The pipeline against plain Python on each stage's own input."""
import re

import corpus_pipeline as P
from ratelens.llm import quality
from ratelens.llm.common import written
from test_ngram_join import brute as near_brute
from test_packing import check
from test_secrets import MASK, brute as spans

SF = "/root/testdata/sf0.001"


def test_stages(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    assert [n for n, _ in P.STAGES] == ["quality", "exact_dedup", "ngram_join", "secret_scan", "packing"]

    def stage(i, df):
        out = P.STAGES[i][1](spark, df, SF)
        return written(out, "test-stage") if i < 4 else out

    good = stage(0, docs)
    assert good.columns == docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id: r for r in good.collect()}
    judged = [(labels[k], k in kept) for k in before if k in labels]
    assert sum(b for q, b in judged if q == 1) >= 0.95 * sum(q for q, _ in judged)
    assert all(before[k] == r for k, r in kept.items())

    once = stage(1, good)
    first = {}
    for k in sorted(kept):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", kept[k].text or ""), k)
    assert sorted(r.doc_id for r in once.collect()) == sorted(first.values())

    apart = stage(2, once)
    rows = [(r.doc_id, r.text) for r in once.collect()]
    assert sorted(r.doc_id for r in apart.collect()) == sorted(k for k, _, c in near_brute(rows, 5, 80) if k == c)

    masked = stage(3, apart)
    texts = {r.doc_id: r.text for r in apart.collect()}
    assert masked.columns == docs.columns
    for r in masked.collect():
        want, at = "", 0
        for start, _, _, end in spans(texts[r.doc_id]):
            want, at = (want + texts[r.doc_id][at:start] + MASK if start >= at else want), max(at, end)
        assert r.text == want + texts[r.doc_id][at:] and r.n_chars == len(r.text)

    rows = [(r.doc_id, r.text) for r in masked.collect()]
    assert check(rows, stage(4, masked).collect(), 1024) == 0


def test_run_gives_the_stages_in_order(spark):
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    assert out.count() > 0 and quality.KEEP_FROM == 0.3
