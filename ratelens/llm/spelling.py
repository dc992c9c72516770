"""Spelling variant grouping by asymmetric q-chunks.

Two words are near when they differ by exactly one inserted, deleted or
replaced code point. The shorter word of a pair (either, at equal length)
contributes its two disjoint halves as chunks; the other contributes the
positional grams that a chunk can meet. One edit leaves a half intact: the
left one where it was, or the right one where it was or, after an insertion,
one place on (the shift). The rest, which holds the edit, is halved again by
the same argument, until what may hold it is short. A key is thus the length,
the short part's number and a 64-bit hash of all that must be intact around
it; words meet on equal keys and are verified by their edit distance, so a
hash collision costs a comparison only.

What crosses the network: one partial count per word and task, 12 keys for
each word of up to 12 letters (24 and 48 for longer ones), and the near pairs.
Words that share a key agree in all but 3 letters (a sixteenth, beyond 48), so no
frequent half of a word gathers its words in one place.

A word's form is its near word of largest count, if that is ``ratio`` times
the word's own at least. Forms are followed to the last by pointer jumping;
counts grow along the way, so there is no ring.

Defined cases: null or empty text has no words; a null id is written as empty
text. Repeated rows count each. Ties for the form go to the word that is
smallest in code-point order. Runs of any length are read whole; a word of a
million letters has at most 48 keys. An empty table gives an empty result.
Only the id and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from ratelens.llm.common import Scratch

# Fixed values of the contract: letters, the folds of the thinned runs, least length and count, ratio.
LETTER = r"[A-Za-zÀ-ÿ]"
THIN = 31
LEAST_LETTERS = 7
LEAST_COUNT = 2
RATIO = 10


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LETTERS) -> DataFrame:
    """One row (word) per run of letters, as the contract thins it: where
    ``THIN`` divides the checksum, one code point is deleted."""
    pattern = f"{LETTER}{{{least},}}"  # a shorter run gives no word of ``least`` letters
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(0))).alias("run"))
    low = runs.select("id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    crc = low.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("crc"))
    at = (F.col("crc") % F.length("run")).cast("int")
    thinned = F.concat(F.left("run", at), F.substr("run", at + 2))
    out = crc.select(F.when(F.col("crc") % THIN == 0, thinned).otherwise(F.col("run")).alias("word"))
    return out.where(F.length("word") >= least)


def vocabulary(found: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words that occur ``least`` times or more."""
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _parts(n: Column) -> Column:
    """Number of parts after halving: until a part has 3 letters at most, 16 parts at most."""
    return F.when(n <= 12, 4).when(n <= 24, 8).otherwise(16)


def _bounds(n: Column, k: Column) -> tuple[Column, Column]:
    """First and end letter of part ``k`` of a word of ``n`` letters."""
    return (F.floor(n * k / _parts(n)).cast("int"), F.floor(n * (k + 1) / _parts(n)).cast("int"))


def _keyed(df: DataFrame, shift: Column) -> DataFrame:
    """A key for each part that may hold the edit: what is intact on its left, and
    on its right after ``shift``, as in a word that is ``shift`` letters shorter."""
    cut = df.withColumn("shift", shift).withColumn("len", F.length("word") - F.col("shift"))
    cut = cut.withColumn("part", F.explode(F.sequence(F.lit(0), _parts(F.col("len")) - 1)))
    lo, hi = _bounds(F.col("len"), F.col("part"))
    key = F.xxhash64("len", "part", F.left("word", lo), F.substr("word", hi + F.col("shift") + 1))
    return cut.select(key.alias("key"), "part", "shift", "word", "n")


def _one_edit(a: Column, b: Column, shift: Column) -> Column:
    """Whether ``b`` is ``a`` with one letter replaced (``shift`` 0) or inserted (1), in linear time."""
    differs = F.zip_with(F.split(a, ""), F.split(F.left(b, F.length(a)), ""), lambda x, y: x != y)
    at = F.array_position(differs, True).cast("int")
    return F.when(at == 0, shift == 1).otherwise(F.substr(a, at + 1 - shift) == F.substr(b, at + 1))


def near_pairs(vocab: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n), once per pair of near words: ``a`` is the shorter, or
    the smaller of two equally long ones."""
    chunks = _keyed(vocab, F.lit(0)).toDF("key", "part", "shift", "a", "a_n").drop("shift")
    # the same length: one code point replaced; one more: one inserted, the right side one place on
    shifts = vocab.withColumn("by", F.explode(F.array(F.lit(0), F.lit(1))))
    grams = _keyed(shifts, F.col("by")).toDF("key", "part", "shift", "b", "b_n")
    met = chunks.join(grams.hint("merge"), ["key", "part"])
    met = met.where((F.length("a") + F.col("shift") == F.length("b")) & ((F.col("shift") == 1) | (F.col("a") < F.col("b"))))
    lo, hi = _bounds(F.length("a"), F.col("part"))
    end = hi + F.col("shift")
    intact = (F.left("a", lo) == F.left("b", lo)) & (F.substr("a", hi + 1) == F.substr("b", end + 1))
    inner_a, inner_b = F.substr("a", lo + 1, hi - lo), F.substr("b", lo + 1, end - lo)
    edit = F.when(hi - lo <= 8, F.levenshtein(inner_a, inner_b, 1) == 1).otherwise(_one_edit(inner_a, inner_b, F.col("shift")))
    return met.where(intact & edit).select("a", "a_n", "b", "b_n").dropDuplicates(["a", "b"])


def forms(pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n_near, form, form_n of every word with a near word."""
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    )).alias("p")).select("p.*")
    best = F.min_by(F.struct("near", "near_n"), F.struct(-F.col("near_n"), "near"))
    out = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = F.col("best.near_n") >= ratio * F.col("n")
    return out.select("word", "n_near", F.when(enough, F.col("best.near")).alias("form"),
                      F.when(enough, F.col("best.near_n")).alias("form_n"))


def roots(formed: DataFrame, scratch: Scratch) -> DataFrame:
    """word, root of every word with a form, following forms to the last."""
    links = scratch.written(formed.where("form is not null").select("word", F.col("form").alias("root")), "spelling-links")
    while True:
        up = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = links.join(up, "root", "left")
        moved = scratch.written(step.select("word", F.coalesce("next", "root").alias("root"),
                                            F.col("next").isNotNull().alias("moved")), "spelling-links")
        if not moved.where("moved").limit(1).count():
            return moved.select("word", "root")
        links = moved.select("word", "root")


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO) -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root."""
    scratch = Scratch(docs.sparkSession)
    vocab = scratch.written(vocabulary(words(docs, id_col, text_col)), "vocabulary")
    formed = scratch.written(forms(near_pairs(vocab), ratio), "spelling-forms")
    last = roots(formed, scratch)
    out = vocab.join(formed, "word", "left").join(last, "word", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form", "form_n",
                      F.coalesce("root", "word").alias("root"))
