"""Row rendering for text reports: fixed-width rows and sentence forms.

Means are shown with two decimals, but for the movie sentence, which shows the
unrounded mean in single precision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.numeric import fixed2, fixed2_or, plain


def _text(c: str, kind: str) -> Column:
    if kind == "f2":
        return F.coalesce(fixed2(c), F.lit(""))
    if kind == "u":
        return F.coalesce(F.col(c).cast("string"), F.lit("Unknown"))
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def fixed_width(df: DataFrame, spec: Sequence[tuple[str, int, str]], sep: str = " | ",
                out: str = "value") -> DataFrame:
    """One left-aligned, padded line per row. ``spec`` items are
    ``(column, width, kind)`` with kind ``s`` (as text, NULL empty), ``u``
    (as text, NULL 'Unknown') or ``f2`` (two decimals)."""
    fmt = sep.join(f"%-{w}s" for _, w, _ in spec)
    return df.select(F.format_string(fmt, *[_text(c, k) for c, _, k in spec]).alias(out))


# Layouts of the text reports.
MOVIE_ROW = [("movie_id", 7, "s"), ("title", 60, "s"), ("avg_rating", 10, "f2"), ("n", 12, "s")]
GENRE_ROW = [("genre", 15, "s"), ("avg_rating", 10, "f2")]
# The gender report prints its (already rounded) mean as a plain number: 4.0, 3.55.
GENDER_ROW = [("movie_id", 7, "s"), ("title", 60, "s"), ("gender", 6, "s"), ("avg_rating", 10, "s"),
              ("n", 10, "s")]
AGE_ROW = [("movie_id", 7, "s"), ("title", 60, "s"), ("age_group", 10, "s"), ("avg_rating", 10, "f2"),
           ("n", 12, "s")]
OCCUPATION_ROW = [("occupation_id", 5, "u"), ("occupation", 20, "s"), ("avg_rating", 10, "f2"), ("n", 12, "s")]
YEAR_ROW = [("year", 8, "s"), ("avg_rating", 10, "f2"), ("n", 12, "s")]


# Texts of the sentences below.
def movie_line() -> Column:
    return F.format_string("Average rating: %s (Total ratings: %d)", plain("avg_rating"), F.col("n"))


def movie_sentence(df: DataFrame) -> DataFrame:
    """title, "Average rating: X (Total ratings: N)" with the unrounded mean."""
    return df.select("title", movie_line().alias("value"))


def genre_sentence(df: DataFrame) -> DataFrame:
    return df.select("genre", F.format_string("Avg: %s,    Count: %d", fixed2("avg_rating"),
                                              F.col("n")).alias("value"))


def gender_sentence(df: DataFrame) -> DataFrame:
    return df.select("title", F.format_string("Male: %s, Female: %s", fixed2("male_avg"),
                                              fixed2("female_avg")).alias("value"))


def age_sentence(df: DataFrame, labels: Sequence[str], columns: Sequence[str], missing: str = "NA") -> DataFrame:
    """title, "0-18: NA<TAB>18-35: 3.75<TAB>..." (one cell per group)."""
    cells = [F.concat(F.lit(f"{lb}: "), fixed2_or(c, missing) if not _is_text(df, c) else F.col(c), F.lit("\t"))
             for lb, c in zip(labels, columns)]
    return df.select("title", F.concat(*cells).alias("value"))


def _is_text(df: DataFrame, c: str) -> bool:
    return dict(df.dtypes)[c] == "string"
