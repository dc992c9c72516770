"""Corpus pipeline over ``documents``: one stage per operator, in order.

Each stage takes (spark, docs, sf_dir), works on all rows that the one before
kept, and returns a DataFrame that is written as Parquet and reread as the
next one's input. All but the last return the columns of ``documents``.

Defined cases: a null text is an empty one in every stage; a document without
id takes part as any other (of copies, the one with the smallest id stays, and a
row without id is never dropped as a copy of one that has an id). Rows that
repeat an id and a text are one document; rows that share an id only are told apart by
their texts. Further columns, whatever their names, pass through all stages but
the last, which returns pieces. Texts of any length are read whole. An empty
table passes as one; without labelled documents the quality stage keeps all, and with
labels of one kind only every document gets that label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratelens.llm import exact_dedup, ngram_join, packing, quality, secrets
from ratelens.llm.common import Scratch, crc_fold, read


def keep_good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents it predicts 0 go."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"), crc_fold(F.col("doc_id"), 5) != 0)
    return quality.keep_good(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the row with the smallest id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join (five words, 0.8): one document of each group stays."""
    return ngram_join.drop_near_copies(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every span found is masked; all documents stay. Texts
    that the shared ledger knows are not scanned again."""
    return secrets.redact_documents(docs, ledger_path=secrets.shared_ledger(spark))


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: the pieces of all documents with their token ids."""
    return packing.pack(docs)


STAGES = [
    ("quality", keep_good_texts),
    ("exact_dedup", drop_exact_copies),
    ("ngram_join", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack_tokens),
]

ORACLE_SQL = None  # a trained classifier decides what goes: no SQL for it


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = read(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        docs = scratch.written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        scratch.clear(keep=1)  # what the stage before kept has been read
    return STAGES[-1][1](spark, docs, sf_dir)
