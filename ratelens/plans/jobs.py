"""End-to-end report jobs that write their outputs.

The review jobs chain as the original jobs do (cleaned reviews are the
input of every later report); the cleaned result is staged once as
Parquet in the shared checkpoint folder instead of being recomputed.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions.text import STOPWORD_PATTERN
from ratelens.plans import ratings as R
from ratelens.plans import reviews as V
from ratelens.sinks import stage, unstage, write_many, write_tsv
from ratelens.sources.files import parse_review_lines


def run_review_jobs(lines: DataFrame, out_dir: str, pattern: str = STOPWORD_PATTERN,
                    k: int = 5) -> dict[str, str]:
    """``lines``: one column ``line`` of raw review lines. Writes the cleaned
    reviews and every review report as tab-separated folders."""
    out = out_dir.rstrip("/")
    cleaned = stage(V.clean_reviews(parse_review_lines(lines), pattern), "reviews_clean")
    by_sentiment = V.top_words_by_category(cleaned, ("positive", "negative"), k)
    aspects = V.aspect_sentiment_counts(cleaned, ("positive", "negative"))
    paths = {
        f"{out}/reviews_clean": V.sorted_reviews(cleaned),
        f"{out}/top_words_k": V.top_words(cleaned, k),
        f"{out}/category_count": V.count_by(cleaned, "category"),
        f"{out}/aspect_count": V.count_by(cleaned, "aspect"),
        f"{out}/top_aspect_negative": V.top_aspect_from_counts(aspects, "negative"),
        f"{out}/top_aspect_positive": V.top_aspect_from_counts(aspects, "positive"),
        f"{out}/top_words_category_positive":
            by_sentiment.where(F.col("sentiment") == "positive").select("category", "word", "freq"),
        f"{out}/top_words_category_negative":
            by_sentiment.where(F.col("sentiment") == "negative").select("category", "word", "freq"),
        f"{out}/top_words_category": V.top_symbol_stripped_words(cleaned, k),
    }
    # Both sentiments' top words and aspect counts come from one pass each;
    # keep those small results for the two outputs that read them.
    for small in (by_sentiment, aspects):
        small.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_many(paths)
    finally:
        for small in (by_sentiment, aspects):
            small.unpersist()
        unstage(cleaned)
    return {p.rsplit("/", 1)[-1]: p for p in paths}


def run_rating_jobs(star: R.RatingsStar, out_dir: str) -> dict[str, str]:
    """Writes every rating report as tab-separated folders.

    The ratings are joined with all user attributes and reduced to the grouping
    sets of every report in one pass; only those sums are staged, and all
    twelve reports start from them. Heavy users are found first, by a count per
    user key. The staged folder is deleted at the end."""
    out = out_dir.rstrip("/")
    partials = stage(R.report_partials(R.with_heavy_users(star)), "rating_partials")
    star = replace(star, partials=partials)
    reports = {
        "movie_mean_count": R.movie_mean_count(star),
        "movie_mean_by_title": R.movie_mean_by_title(star),
        "best_movie_min5": R.best_movie(star, 5),
        "best_movie_min50_rounded": R.best_movie(star, 50, rounded=True),
        "genre_mean_count": R.genre_mean_count(star),
        "genre_mean_desc": R.genre_mean_desc(star),
        "gender_wide": R.gender_wide(star),
        "gender_long": R.gender_long(star),
        "age_wide_4": R.age_wide_text(star, "four"),
        "age_long_5": R.age_long(star, "five"),
        "occupation_mean": R.occupation_mean(star),
        "year_mean": R.year_mean(star),
    }
    try:
        for name, df in reports.items():
            write_tsv(df, f"{out}/{name}")
    finally:
        unstage(partials)
    return {name: f"{out}/{name}" for name in reports}
