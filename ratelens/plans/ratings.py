"""Rating reports over a star of DataFrames (ratings, movies, users,
occupations). Each report is one declarative plan; Catalyst prunes columns
down to the parquet scans and picks join strategies from sizes.

Plan shape used throughout: aggregate the fact as early as the report
allows (per item, or per user key when the grouping is a user attribute),
then enrich the small aggregate, then sort.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.buckets import PRESETS, bucket_ordinal, bucketize
from ratelens.functions.numeric import fixed2, fixed2_or, plain
from ratelens.functions.render import movie_line
from ratelens.functions.time import year_utc
from ratelens.operators.aggregate import (CNT, SUM, combine, conditional_combine, conditional_means, finish, mean_by_dimension,
                                          mean_count, sum_count)
from ratelens.operators.best import best_with_support, qualifying
from ratelens.operators.explode import explode_values
from ratelens.operators.lookup import heavy_keys, lookup, lookup_past_nulls, spread_lookup, title_fallback

UNKNOWN = "Unknown"


@dataclass
class RatingsStar:
    """ratings: user_key, movie_id, rating, ts
    movies: movie_id, title, genres      users: user_key, user_id, gender, age, occupation_id
    occupations: occupation_id, occupation
    partials: the (sum, count) rows of ``report_partials``, when a job has computed them once.
    heavy_users: user keys with a large share of the ratings (``with_heavy_users``).
    split: the ratings with and without a user key, where they are stored apart.

    Keys are unique in movies, users and occupations (the readers' ``last``
    option keeps the last row of a repeated key)."""
    ratings: DataFrame
    movies: DataFrame
    users: DataFrame
    occupations: DataFrame | None = None
    partials: DataFrame | None = None
    heavy_users: tuple = ()
    split: tuple | None = None

    @property
    def titles(self) -> DataFrame:
        return self.movies.select("movie_id", "title")

    def partial(self, name: str) -> DataFrame:
        """The rows of one grouping set of ``partials``."""
        keys = REPORT_SETS[name]
        return self.partials.where(F.col("_set") == name).select(*keys, SUM, CNT)

    def per_movie(self) -> DataFrame:
        return self.partial("movie") if self.partials is not None else sum_count(self.ratings, "movie_id")

    def rated_with(self, *attrs: str) -> DataFrame:
        """Ratings carrying the given user attributes, NULL for an unknown
        user; a known user's missing gender is empty text. Ratings already
        enriched by ``enrich_users`` are used as is."""
        if all(a in self.ratings.columns for a in attrs):
            return self.ratings
        return lookup_past_nulls(self.ratings, user_attributes(self, *attrs), "user_key", self.heavy_users, self.split)

    def rated_by_known(self, *attrs: str) -> DataFrame:
        """Ratings of known users only. The merge hint keeps the fact from
        ever being the broadcast side, which an inner join would allow."""
        if all(a in self.ratings.columns for a in attrs):
            return self.ratings.where(F.col("_user_known"))
        known = self.split[0] if self.split else self.ratings
        return spread_lookup(known.hint("merge"), user_attributes(self, *attrs), "user_key", self.heavy_users, how="inner")


USER_ATTRS = ("gender", "age", "occupation_id")

# What the reports group by; each is one grouping set of ``report_partials``.
REPORT_SETS = {"movie": ["movie_id"], "gender": ["movie_id", "gender"], "age_four": ["movie_id", "age_four"],
               "age_five": ["movie_id", "age_five"], "occupation": ["occupation_id"], "year": ["year"]}


def user_attributes(star: RatingsStar, *attrs: str) -> DataFrame:
    filled = [F.coalesce("gender", F.lit("")).alias("gender") if a == "gender" else F.col(a) for a in attrs]
    return star.users.select("user_key", *filled)


def enrich_users(star: RatingsStar) -> RatingsStar:
    """Attach every user attribute to the ratings with one join.

    Reports by gender, age and occupation then reuse the enriched ratings
    instead of each joining (and shuffling) the whole fact again; stage the
    result (``sinks.stage``) when several reports read it."""
    users = user_attributes(star, *USER_ATTRS).withColumn("_user_known", F.lit(True))
    rated = lookup_past_nulls(star.ratings, users, "user_key", star.heavy_users, star.split)
    rated = rated.withColumn("_user_known", F.coalesce("_user_known", F.lit(False)))
    return replace(star, ratings=rated, split=None)


def with_heavy_users(star: RatingsStar, most: int = 1000) -> RatingsStar:
    """The star with its heavy users found (``operators.lookup.heavy_keys``),
    whose ratings the user joins then spread."""
    return replace(star, heavy_users=heavy_keys(star.ratings, "user_key", most))


def report_partials(star: RatingsStar) -> DataFrame:
    """(sum, count) per grouping set of ``REPORT_SETS``, all from one pass over
    the ratings: ``_set`` names the set a row belongs to."""
    rated = enrich_users(star).ratings.select(
        "movie_id", "gender", bucketize("age", "four").alias("age_four"), bucketize("age", "five").alias("age_five"),
        "occupation_id", year_utc("ts").alias("year"), "rating")
    cols = [c for c in rated.columns if c != "rating"]
    ids = {name: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in keys) for name, keys in REPORT_SETS.items()}
    sums = rated.groupingSets(list(REPORT_SETS.values()), *cols).agg(
        F.sum("rating").alias(SUM), F.count("rating").alias(CNT), F.grouping_id().alias("_id"))
    name = F.create_map(*[F.lit(x) for name, i in ids.items() for x in (i, name)])
    return sums.withColumn("_set", F.element_at(name, F.col("_id").cast("int"))).drop("_id")


def _with_titles(stats: DataFrame, star: RatingsStar, on_missing: str) -> DataFrame:
    how = "inner" if on_missing == "drop" else "left"
    return lookup(stats, star.titles, "movie_id", how=how, defaults=title_fallback(on_missing))


# --- per movie --------------------------------------------------------------

def movie_stats(star: RatingsStar, rounded: bool = True, on_missing: str = "drop") -> DataFrame:
    """movie_id, title, avg_rating, n (aggregate first, then titles)."""
    stats = finish(star.per_movie(), rounded=rounded)
    return _with_titles(stats, star, on_missing).select("movie_id", "title", "avg_rating", "n")


def movie_mean_count(star: RatingsStar, on_missing: str = "drop") -> DataFrame:
    """Mean (2 decimals) and count per movie, best first."""
    return movie_stats(star, True, on_missing).orderBy(F.desc("avg_rating"), "movie_id")


def movie_mean_by_title(star: RatingsStar, on_missing: str = "key") -> DataFrame:
    """Exact mean and count per movie, ordered by title (movies sharing a
    title stay separate rows, ordered by id)."""
    return movie_stats(star, False, on_missing).orderBy("title", "movie_id")


def best_movie(star: RatingsStar, min_n: int = 5, rounded: bool = False,
               on_missing: str = "drop") -> DataFrame:
    """One row: the highest mean among movies with >= ``min_n`` ratings
    (ties to the lowest id) plus a sentence; NULLs and a fallback sentence
    when no movie qualifies."""
    best = best_with_support(movie_stats(star, rounded, on_missing), min_n,
                             strictly_positive=not rounded)
    return best.withColumn("result", result_sentence(F.col("found"), min_n, rounded)).drop("found")


def result_sentence(found: Column, min_n: int, rounded: bool) -> Column:
    # Result sentences.
    best = F.format_string(
        "%s is the highest rated movie with an average rating of %s among movies with at least %d ratings.",
        F.col("title"), fixed2("avg_rating") if rounded else plain("avg_rating"), F.lit(min_n))
    return F.when(found, best).otherwise(F.lit(f"No movies has at least {min_n} ratings."))


def movie_report_with_result(star: RatingsStar, min_n: int = 5) -> DataFrame:
    """title, value: one sentence per movie, then a ``RESULT`` line naming
    the best movie with at least ``min_n`` ratings (or saying none has)."""
    stats = lookup(finish(star.per_movie(), rounded=False), star.titles, "movie_id")
    kind = dict(stats.dtypes)["movie_id"]
    # Each movie stands once for its own line and once as a candidate of the
    # result line, so both come from one aggregate of the ratings. One seed
    # row makes the result line exist without any movie.
    own = F.struct(F.lit(0).alias("o"), F.col("movie_id").alias("key"))
    candidate = F.struct(F.lit(1).alias("o"), F.lit(None).cast(kind).alias("key"))
    rows = stats.select("*", F.explode(F.array(own, candidate)).alias("_as"))
    rows = rows.where((F.col("_as.o") == 0) | (F.col("title").isNotNull() & qualifying(min_n)))
    seed = stats.sparkSession.range(1).select(*[F.lit(None).cast(t).alias(c) for c, t in stats.dtypes], candidate.alias("_as"))
    one = F.max_by(F.struct("movie_id", "title", "avg_rating", "n"), F.struct("avg_rating", -F.col("movie_id")))
    best = rows.unionByName(seed).groupBy("_as").agg(one.alias("_b")).select("_as.o", "_b.*")
    line = F.when(F.col("o") == 0, movie_line()).otherwise(result_sentence(F.col("movie_id").isNotNull(), min_n, False))
    title = F.when(F.col("o") == 1, F.lit("RESULT")).otherwise(F.coalesce("title", F.col("movie_id").cast("string")))
    return (best.select(title.alias("title"), line.alias("value"), "o", "movie_id")
            .orderBy("o", "title", "movie_id").select("title", "value"))


# --- per genre --------------------------------------------------------------

def genre_stats(star: RatingsStar) -> DataFrame:
    """genre, avg_rating, n. Ratings are reduced to one (sum, count) row per
    movie before the one-to-many join with the exploded genres, so the
    explode multiplies movies, not ratings. Unknown movies drop out."""
    partial = star.per_movie()
    genres = explode_values(star.movies.select("movie_id", "genres"), "genres", out="genre")
    return finish(combine(partial.join(genres, "movie_id"), "genre"))


def genre_mean_count(star: RatingsStar) -> DataFrame:
    return genre_stats(star).orderBy("genre")


def genre_mean_desc(star: RatingsStar) -> DataFrame:
    return genre_stats(star).select("genre", "avg_rating").orderBy(F.desc("avg_rating"), "genre")


# --- per user attribute -------------------------------------------------------

def gender_wide(star: RatingsStar) -> DataFrame:
    """movie_id, title, male_avg, female_avg: everything not 'M' (including
    unknown users) counts as female; an empty side is 0; a missing title
    shows the id."""
    male = F.col("gender") == "M"
    cases = {"male_avg": male, "female_avg": ~F.col("gender").eqNullSafe("M")}
    if star.partials is not None:
        wide = conditional_combine(star.partial("gender"), "movie_id", cases, empty=0.0)
    else:
        wide = conditional_means(star.rated_with("gender"), "movie_id", "rating", cases, empty=0.0)
    out = lookup(wide, star.titles, "movie_id", defaults=title_fallback("key"))
    return out.select("movie_id", "title", "male_avg", "female_avg").orderBy("title", "movie_id")


def _id_key(col: str, id_order: str):
    """Sort key for ids: ``numeric`` (default) or ``string`` (as text, so
    that 1010 sorts before 999)."""
    if id_order not in ("numeric", "string"):
        raise ValueError(f"id_order must be 'numeric' or 'string', got {id_order!r}")
    return F.col(col) if id_order == "numeric" else F.col(col).cast("string")


def gender_long(star: RatingsStar, id_order: str = "numeric") -> DataFrame:
    """movie_id, title, gender, avg_rating, n; unknown users form their own
    'Unknown' group, a missing title reads 'Unknown'."""
    named = F.coalesce("gender", F.lit(UNKNOWN))
    if star.partials is not None:
        stats = finish(combine(star.partial("gender").withColumn("gender", named), ["movie_id", "gender"]))
    else:
        stats = mean_count(star.rated_with("gender").withColumn("gender", named), ["movie_id", "gender"])
    out = lookup(stats, star.titles, "movie_id", defaults=title_fallback("unknown"))
    return (out.select("movie_id", "title", "gender", "avg_rating", "n")
            .orderBy(_id_key("movie_id", id_order), "gender"))


def _age_rated(star: RatingsStar, preset: str) -> DataFrame:
    """Ratings of known users with a known age, tagged with the age group."""
    rated = star.rated_by_known("age")
    return rated.withColumn("age_group", bucketize("age", preset)).where(F.col("age_group").isNotNull())


def _age_partial(star: RatingsStar, preset: str) -> DataFrame:
    """An unknown user has no age, so no age group either."""
    return star.partial(f"age_{preset}").withColumnRenamed(f"age_{preset}", "age_group").where(F.col("age_group").isNotNull())


def age_column(label: str) -> str:
    return "age_" + label.replace("-", "_").replace("+", "_plus")


def age_wide(star: RatingsStar, preset: str = "four") -> DataFrame:
    """movie_id, title, one mean column per age group (NULL when the group
    has no rating); a missing title shows the id."""
    labels = PRESETS[preset].labels
    cases = {age_column(lb): F.col("age_group") == lb for lb in labels}
    if star.partials is not None:
        wide = conditional_combine(_age_partial(star, preset), "movie_id", cases)
    else:
        wide = conditional_means(_age_rated(star, preset), "movie_id", "rating", cases)
    out = lookup(wide, star.titles, "movie_id", defaults=title_fallback("key"))
    return out.select("movie_id", "title", *cases).orderBy("title", "movie_id")


def age_wide_text(star: RatingsStar, preset: str = "four", missing: str = "NA") -> DataFrame:
    """``age_wide`` with two-decimal strings and ``NA`` for empty groups."""
    wide = age_wide(star, preset)
    cols = [c for c in wide.columns if c.startswith("age_")]
    return wide.select("movie_id", "title", *[fixed2_or(c, missing).alias(c) for c in cols])


def age_long(star: RatingsStar, preset: str = "five", id_order: str = "numeric") -> DataFrame:
    """movie_id, title, age_group, avg_rating, n; unknown users and unknown
    movies are dropped; groups in age order."""
    if star.partials is not None:
        stats = finish(_age_partial(star, preset))
    else:
        stats = mean_count(_age_rated(star, preset), ["movie_id", "age_group"])
    out = lookup(stats, star.titles, "movie_id", how="inner")
    return (out.select("movie_id", "title", "age_group", "avg_rating", "n")
            .orderBy(_id_key("movie_id", id_order), bucket_ordinal("age_group", preset)))


def occupation_mean(star: RatingsStar) -> DataFrame:
    """occupation_id, occupation, avg_rating, n. Unknown user -> (NULL,
    'Unknown'); unknown occupation id -> (id, 'Unknown'). The ratings are
    reduced per user key before the join (see ``mean_by_dimension``)."""
    if star.partials is not None or "occupation_id" in star.ratings.columns:  # already enriched: group, then name
        partial = star.partial("occupation") if star.partials is not None else sum_count(star.ratings, "occupation_id")
        named = lookup(partial, star.occupations, "occupation_id", defaults={"occupation": UNKNOWN})
        out = finish(combine(named, ["occupation_id", "occupation"]))
    else:
        user_occ = lookup(star.users.select("user_key", "occupation_id"), star.occupations,
                          "occupation_id", defaults={"occupation": UNKNOWN})
        out = mean_by_dimension(star.ratings, user_occ, "user_key", ["occupation_id", "occupation"],
                                defaults={"occupation": UNKNOWN})
    return (out.select("occupation_id", "occupation", "avg_rating", "n")
            .orderBy(F.desc("avg_rating"), F.asc_nulls_last("occupation_id"), "occupation"))


# --- per year ----------------------------------------------------------------

def year_mean(star: RatingsStar) -> DataFrame:
    """year (UTC), avg_rating, n."""
    if star.partials is not None:
        return finish(star.partial("year")).orderBy("year")
    rated = star.ratings.select(year_utc("ts").alias("year"), "rating")
    return mean_count(rated, "year").orderBy("year")
