"""Review reports: cleaning, word/category/aspect counts, per-category
top words. Input is a reviews DataFrame (id, review, aspect, category,
sentiment); texts are processed whole.

Counting follows the rule that a row counts only when a chosen column is
non-NULL (``count(col)``), as noted per report.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions.text import (STOPWORD_PATTERN, TOKEN_SEPARATORS, clean_review, java_trim, live_phrases, raw_tokens,
                                     strip_symbols, strip_symbols_keep_separators)
from ratelens.operators.topk import top_k, top_k_per_group


def of_sentiment(reviews: DataFrame, sentiments: Sequence[str]) -> DataFrame:
    """Rows whose trimmed lower-case sentiment is one of ``sentiments``."""
    return reviews.where(F.lower(java_trim("sentiment")).isin(list(sentiments)))


def clean_reviews(parsed: DataFrame, pattern=STOPWORD_PATTERN) -> DataFrame:
    """Lower-case, remove stop words, punctuation to spaces, collapse
    whitespace, trim. ``pattern`` is a regex string (or a Column)."""
    return parsed.withColumn("review", clean_review("review", pattern))


def sorted_reviews(cleaned: DataFrame) -> DataFrame:
    """Ordered by id, aspect, category. The order among equal keys is
    unspecified, so a per-row tiebreaker is added: rows sharing one key
    (junk lines with NULL keys, copies of one review) can then be split
    across range partitions instead of all landing in one task."""
    return cleaned.orderBy("id", "aspect", "category", F.monotonically_increasing_id())


def clean_sorted_reviews(parsed: DataFrame, pattern=STOPWORD_PATTERN) -> DataFrame:
    """Cleaned reviews ordered by id, aspect, category.

    The sort key comes from parsing alone, so rows are sorted first and
    cleaned after (a row-wise projection keeps the order). The range
    partitioner's sampling pass then re-reads parsed rows only, instead of
    cleaning every text twice."""
    return clean_reviews(sorted_reviews(parsed), pattern)


def _words(df: DataFrame, text, *keep: str) -> DataFrame:
    """One row per non-empty token. Splitting and exploding first, then
    dropping empty strings in a plain filter, keeps the work in generated
    code (a lambda filter on the array would not be)."""
    return (df.select(*keep, F.explode(F.split(text, TOKEN_SEPARATORS)).alias("word"))
            .where(F.col("word") != ""))


def word_counts(cleaned: DataFrame) -> DataFrame:
    """word, freq over all reviews (tokens of the lower-cased review)."""
    words = _words(cleaned, F.lower("review"))
    return words.groupBy("word").agg(F.count("word").alias("freq"))


def cleaned_word_counts(reviews: DataFrame, keys: Sequence[str] = (), counted: str | None = None,
                        pattern=STOPWORD_PATTERN, word=lambda w: w, out: str = "freq") -> DataFrame:
    """*keys, word, ``out``: the words of the cleaned reviews, counted from the
    raw ones (rows whose ``counted`` column is non-NULL, or all).

    Raw tokens are counted first, partially in each task; then only the
    distinct ones are cleaned, split and put through ``word``, and the counts summed
    again. Empty words are dropped. A pattern that is no word list (or a Column)
    cleans every text instead, with the same result."""
    keys = list(keys)
    one = [F.count(counted if counted else F.lit(1)).alias("_n")]
    keep = list(dict.fromkeys([*keys, *([counted] if counted else [])]))
    if isinstance(pattern, str) and live_phrases(pattern) is not None:
        raw = reviews.select(*keep, F.explode(raw_tokens("review", pattern)).alias("_raw")).where(F.col("_raw") != "")
        distinct = raw.groupBy(*keys, "_raw").agg(*one)
        pieces = distinct.select(*keys, "_n", F.explode(F.split(clean_review("_raw", pattern), TOKEN_SEPARATORS)).alias("_piece"))
    else:
        pieces = (reviews.select(*keep, F.explode(F.split(F.lower(clean_review("review", pattern)), TOKEN_SEPARATORS)).alias("_piece"))
                  .groupBy(*keys, "_piece").agg(*one))
    words = pieces.select(*keys, "_n", word(F.col("_piece")).alias("word")).where(F.col("word") != "")
    return words.groupBy(*keys, "word").agg(F.sum("_n").alias(out))


def top_words(cleaned: DataFrame, k: int = 5) -> DataFrame:
    return top_k(word_counts(cleaned), k, [F.desc("freq"), "word"])


def top_cleaned_words(reviews: DataFrame, k: int = 5, pattern=STOPWORD_PATTERN) -> DataFrame:
    """``top_words`` of the cleaned reviews, from the raw ones."""
    return top_k(cleaned_word_counts(reviews, pattern=pattern), k, [F.desc("freq"), "word"])


def count_by(cleaned: DataFrame, key: str, counted: str = "id", out: str = "total_comments") -> DataFrame:
    """Rows per ``key`` counting rows whose ``counted`` column is non-NULL."""
    return (cleaned.groupBy(key).agg(F.count(counted).alias(out))
            .orderBy(F.desc(out), F.asc_nulls_last(key)))


def top_aspect(cleaned: DataFrame, sentiment: str, k: int = 1) -> DataFrame:
    """aspect, total_<sentiment>: the aspect(s) with most reviews of the
    given sentiment (trimmed aspect, trimmed lower-case sentiment, both
    non-NULL); ties go to the smaller aspect."""
    out = f"total_{sentiment}"
    rows = of_sentiment(cleaned, [sentiment]).select(java_trim("aspect").alias("aspect"))
    counts = rows.where(F.col("aspect").isNotNull()).groupBy("aspect").agg(F.count("aspect").alias(out))
    return top_k(counts, k, [F.desc(out), "aspect"])


def aspect_sentiment_counts(cleaned: DataFrame, sentiments: Sequence[str] = ("positive", "negative")
                            ) -> DataFrame:
    """aspect, total_<sentiment> for every requested sentiment in one pass
    (trimmed aspect, trimmed lower-case sentiment); aspects with no review
    of any requested sentiment are dropped."""
    aspect = java_trim("aspect")
    sentiment = F.lower(java_trim("sentiment"))
    counts = [F.count(F.when(sentiment == s, F.col("aspect"))).alias(f"total_{s}") for s in sentiments]
    any_hit = reduce(lambda a, b: a | b, [F.col(f"total_{s}") > 0 for s in sentiments])
    return cleaned.groupBy(aspect.alias("aspect")).agg(*counts).where(any_hit)


def top_aspect_from_counts(counts: DataFrame, sentiment: str, k: int = 1) -> DataFrame:
    out = f"total_{sentiment}"
    return top_k(counts.where(F.col(out) > 0).select("aspect", out), k, [F.desc(out), "aspect"])


def top_words_by_category(cleaned: DataFrame, sentiments: Sequence[str] = ("positive", "negative"),
                          k: int = 5, min_chars: int = 3) -> DataFrame:
    """sentiment, category, word, freq: the ``k`` most frequent words of at
    least ``min_chars`` characters per (sentiment, category), for all
    requested sentiments in one pass. Rows without id are skipped; a word
    counts when its category is non-NULL.

    Filter by sentiment before cleaning (``of_sentiment``): only those texts
    are then cleaned."""
    rows = of_sentiment(cleaned, sentiments).where(F.col("id").isNotNull())
    words = rows.select(F.lower(java_trim("sentiment")).alias("sentiment"), "category",
                        F.explode(F.split("review", TOKEN_SEPARATORS)).alias("word"))
    words = words.where(F.char_length("word") >= min_chars)
    counts = words.groupBy("sentiment", "category", "word").agg(F.count("category").alias("freq"))
    return top_k_per_group(counts, ["sentiment", "category"], [F.desc("freq"), "word"], k)


def top_cleaned_words_by_category(reviews: DataFrame, sentiments: Sequence[str] = ("positive", "negative"),
                                  k: int = 5, min_chars: int = 3, pattern=STOPWORD_PATTERN) -> DataFrame:
    """``top_words_by_category`` of the cleaned reviews, from the raw ones."""
    rows = of_sentiment(reviews, sentiments).where(F.col("id").isNotNull())
    rows = rows.select(F.lower(java_trim("sentiment")).alias("sentiment"), "category", "review")
    counts = cleaned_word_counts(rows, ["sentiment", "category"], "category", pattern)
    counts = counts.where(F.char_length("word") >= min_chars)
    return top_k_per_group(counts, ["sentiment", "category"], [F.desc("freq"), "word"], k)


def top_cleaned_words_for_sentiment(reviews: DataFrame, sentiment: str, k: int = 5, pattern=STOPWORD_PATTERN) -> DataFrame:
    return (top_cleaned_words_by_category(reviews, [sentiment], k, pattern=pattern).select("category", "word", "freq"))


def top_symbol_stripped_cleaned_words(reviews: DataFrame, k: int = 5, pattern=STOPWORD_PATTERN) -> DataFrame:
    """``top_symbol_stripped_words`` of the cleaned reviews, from the raw ones."""
    counts = cleaned_word_counts(reviews, ["category"], "aspect", pattern, strip_symbols, "cnt")
    return top_k_per_group(counts, "category", [F.desc("cnt"), "word"], k)


def top_words_for_sentiment(cleaned: DataFrame, sentiment: str, k: int = 5) -> DataFrame:
    return top_words_by_category(cleaned, [sentiment], k).select("category", "word", "freq")


def top_symbol_stripped_words(cleaned: DataFrame, k: int = 5) -> DataFrame:
    """category, word, cnt over all sentiments: tokens of the lower-cased
    review with every character outside [a-zA-Z0-9à-ỹ] removed; empty
    results dropped; a word counts when its aspect is non-NULL."""
    words = _words(cleaned, strip_symbols_keep_separators(F.lower("review")), "aspect", "category")
    counts = words.groupBy("category", "word").agg(F.count("aspect").alias("cnt"))
    return top_k_per_group(counts, "category", [F.desc("cnt"), "word"], k)
