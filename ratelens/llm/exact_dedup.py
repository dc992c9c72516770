"""Exact dedup by skew-safe combining of content.

Equal texts are those identical after every run of blanks (space, tab, line
feed, vertical tab, form feed, carriage return) becomes one space. Three
combining steps, each grouping on the digest **and** the whole text, so that
two texts with one digest never merge:

1. local: the map side of the first grouping leaves one row per text and task;
2. salted: those rows meet per (digest, salt), the salt being the task that
   made them, so a text with copies everywhere reaches ``salts`` tasks;
3. global: at most ``salts`` winners per text meet and give the keeper.

The keepers (no texts) then join back to the rows on the digest, a second
64-bit hash and the length: 320 bits and a length stand for the content there,
so that texts need not cross once more. The rows of a text with very many copies
are dealt to several tasks in that join.

Texts of any length are compared whole.

Defined cases: null text is empty; all empty texts are one group. Ties do not
occur between distinct ids; rows that repeat an id and a text count in
``group_size`` and share one fate (all kept or all dropped). A null id is
larger than any id; a group of null ids only has a null ``keep_id`` and its
rows are kept. ``drop_copies`` leaves one row of those that repeat an id and a
text; a row without id that copies a row with one is marked but stays there. An empty table gives an empty result. Only the id and text
columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ratelens.llm.common import Scratch, normal_blanks, salted_join

SALTS = 16


def _addressed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = df.select(F.col(id_col).alias("doc_id"), normal_blanks(F.col(text_col)).alias("content"))
    return norm.select("doc_id", "content", F.unhex(F.sha2("content", 256)).alias("digest"))


def keepers(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per distinct content: digest, h2, n, keep_id, group_size."""
    rows = _addressed(df, id_col, text_col).withColumn("salt", F.spark_partition_id() % salts)
    salted = (rows.groupBy("digest", "salt", "content")
              .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n_rows")))
    winners = (salted.groupBy("digest", "content")
               .agg(F.min("keep_id").alias("keep_id"), F.sum("n_rows").alias("group_size")))
    return winners.select("digest", F.xxhash64("content").alias("h2"), F.length("content").alias("n"),
                          "keep_id", "group_size")


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = (_addressed(df, id_col, text_col)
            .select("doc_id", "digest", F.xxhash64("content").alias("h2"), F.length("content").alias("n")))
    rows = Scratch(df.sparkSession).written(rows, "text-digests")
    out = salted_join(rows, keepers(df, id_col, text_col, salts), ["digest", "h2", "n"], ["doc_id"])
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(df: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of ``df`` (columns unchanged) without the dropped copies, decided
    by id and content, and one row of each equal id and content: the smallest."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # names of the caller cannot clash
    key, text = (F.col(f"c{df.columns.index(c)}") for c in ("doc_id", "text"))
    norm = plain.withColumn("content", normal_blanks(text))
    rows = norm.select(*plain.columns, key.isNull().alias("no_id"), F.coalesce(key.cast("string"), F.lit("")).alias("id"),
                       F.unhex(F.sha2("content", 256)).alias("digest"), F.xxhash64("content").alias("h2"), F.length("content").alias("n"))
    by = ["no_id", "id", "digest", "h2", "n"]
    kept = keepers(df, salts=salts).withColumn("keep", F.coalesce(F.col("keep_id").cast("string"), F.lit("")))
    ids = Scratch(df.sparkSession).written(rows.select(*by), "text-digests")
    copies = (salted_join(ids, kept.select("digest", "h2", "n", "keep"), ["digest", "h2", "n"], ["id"])
              .where(~F.col("no_id") & (F.col("id") != F.col("keep"))).select(by).distinct())
    # the join leaves the rows where the window needs them: texts move once
    order = [text, *[c for c, t in plain.dtypes if "map<" not in t]]
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    left = rows.join(copies.hint("merge"), by, "left_anti").withColumn("place", place).where("place = 1")
    return left.select(plain.columns).toDF(*df.columns)
