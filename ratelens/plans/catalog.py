"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver tables whole (see ``ratelens.sources.tables``
for the role mapping) and returns a lazy DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ratelens.functions import render as P
from ratelens.plans import ratings as R
from ratelens.plans import reviews as V
from ratelens.sinks import as_text, stage_path, write_tsv
from ratelens.sources import files, tables


def star(spark: SparkSession, sf_dir: str) -> R.RatingsStar:
    return R.RatingsStar(
        ratings=tables.ratings(spark, sf_dir),
        movies=tables.movies(spark, sf_dir),
        users=tables.users(spark, sf_dir),
        occupations=tables.occupations(spark, sf_dir),
    )


def parsed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.parse_review_lines(tables.review_lines(spark, sf_dir))


def _ratings_union_all(spark, d):
    first, second = tables.rating_files(spark, d)
    return first.unionByName(second)


def _star(fn, **kw):
    return lambda spark, d: fn(star(spark, d), **kw)


def _rendered(report, render, **kw):
    """A star report followed by a row rendering (fixed width or sentence)."""
    return lambda spark, d: render(report(star(spark, d), **kw))


def _fixed(row):
    return lambda df: P.fixed_width(df, row)


def _age_sentence(star_):
    wide = R.age_wide_text(star_, "four")
    labels = R.PRESETS["four"].labels
    return P.age_sentence(wide, labels, [R.age_column(x) for x in labels])


def _columns(fn, **kw):
    """A count over review columns; the text is never read."""
    return lambda spark, d: fn(tables.reviews(spark, d), **kw)


def _words(fn, **kw):
    """A word report over all texts."""
    return lambda spark, d: fn(tables.review_texts(spark, d), **kw)


def _words_of(fn, **kw):
    """A word report over the texts of some sentiments."""
    return lambda spark, d: fn(tables.reviews(spark, d), **kw)


def _lines(parse, lines, **kw):
    """Lines of a comma file parsed under a bad-record policy."""
    return lambda spark, d: parse(lines(spark, d).select("value", *(["_order"] if kw.get("last") else [])), **kw)


def _ratings_two_files(spark, d):
    """Two rating files, written as text to the shared folder and read in one scan."""
    paths = []
    for name, part in zip(("first", "second"), tables.rating_files(spark, d), strict=True):
        paths.append(stage_path(spark, f"ratings_{name}"))
        as_text(part.select("user_key", "movie_id", "rating", "ts"), ",").write.text(paths[-1])
    return files.read_ratings(spark, paths)


def _reviews_tsv(spark, d):
    """Reviews written as an escaped tab-separated file and read back."""
    path = stage_path(spark, "reviews_tsv")
    write_tsv(tables.text_reviews(spark, d), path, escaped=True)
    return files.read_reviews_tsv(spark, path, escaped=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # ratings star
    "movie_mean_count": _star(R.movie_mean_count),
    "movie_mean_by_title": _star(R.movie_mean_by_title),
    "best_movie_min5": _star(R.best_movie, min_n=5),
    "best_movie_min5_rounded": _star(R.best_movie, min_n=5, rounded=True),
    "best_movie_min50_rounded": _star(R.best_movie, min_n=50, rounded=True),
    "genre_mean_count": _star(R.genre_mean_count),
    "genre_mean_desc": _star(R.genre_mean_desc),
    "gender_wide": _star(R.gender_wide),
    "gender_long_unknown": _star(R.gender_long),
    "age_wide_4": _star(R.age_wide_text, preset="four"),
    "age_long_5": _star(R.age_long, preset="five"),
    "occupation_mean": _star(R.occupation_mean),
    "year_mean": _star(R.year_mean),
    "ratings_union_all": _ratings_union_all,
    # rendered report rows
    "movie_mean_count_text": _rendered(R.movie_mean_count, _fixed(P.MOVIE_ROW)),
    "movie_sentence": _rendered(R.movie_mean_by_title, P.movie_sentence),
    "movie_report_with_result": _star(R.movie_report_with_result, min_n=5),
    "genre_mean_desc_text": _rendered(R.genre_mean_desc, _fixed(P.GENRE_ROW)),
    "gender_long_text": _rendered(R.gender_long, _fixed(P.GENDER_ROW)),
    "age_long_text": _rendered(R.age_long, _fixed(P.AGE_ROW), preset="five"),
    "occupation_mean_text": _rendered(R.occupation_mean, _fixed(P.OCCUPATION_ROW)),
    "year_mean_text": _rendered(R.year_mean, _fixed(P.YEAR_ROW)),
    "genre_mean_sentence": _rendered(R.genre_mean_count, P.genre_sentence),
    "gender_wide_sentence": _rendered(R.gender_wide, P.gender_sentence),
    "age_wide_sentence": lambda spark, d: _age_sentence(star(spark, d)),
    # comma files
    "rating_lines_drop": _lines(files.parse_rating_lines, tables.rating_lines, on_bad="drop"),
    "rating_lines_null": _lines(files.parse_rating_lines, tables.rating_lines, on_bad="null"),
    "movie_lines_drop": _lines(files.parse_movie_lines, tables.movie_lines, on_bad="drop"),
    "movie_lines_null": _lines(files.parse_movie_lines, tables.movie_lines, on_bad="null"),
    "user_lines_drop": _lines(files.parse_user_lines, tables.user_lines, on_bad="drop"),
    "user_lines_null": _lines(files.parse_user_lines, tables.user_lines, on_bad="null"),
    "user_lines_last": _lines(files.parse_user_lines, tables.user_lines, on_bad="drop", last=True),
    "occupation_lines_drop": _lines(files.parse_occupation_lines, tables.occupation_lines, on_bad="drop"),
    "ratings_two_files": _ratings_two_files,
    "reviews_tsv_roundtrip": _reviews_tsv,
    # reviews
    "reviews_parse": parsed_reviews,
    "reviews_clean": lambda spark, d: V.clean_sorted_reviews(parsed_reviews(spark, d)),
    "top_words_k": _words(V.top_cleaned_words, k=5),
    "category_count": _columns(V.count_by, key="category"),
    "aspect_count": _columns(V.count_by, key="aspect"),
    "top_aspect_positive": _columns(V.top_aspect, sentiment="positive"),
    "top_aspect_negative": _columns(V.top_aspect, sentiment="negative"),
    "top_words_category_positive": _words_of(V.top_cleaned_words_for_sentiment, sentiment="positive"),
    "top_words_category_negative": _words_of(V.top_cleaned_words_for_sentiment, sentiment="negative"),
    "top_words_category": _words(V.top_symbol_stripped_cleaned_words, k=5),
    "top_words_category_by_sentiment": _words_of(V.top_cleaned_words_by_category, sentiments=("positive", "negative"), k=5),
}
