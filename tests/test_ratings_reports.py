"""Rating reports on the invented star (see conftest): ratings
(1,10,3.5,2020) (4,10,5.0,2019) (9,10,4.0,2020) (1,99,2.0,2020);
user 9 and movie 99 are unknown; occupation 7 is unknown."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from ratelens.functions.buckets import bucketize
from ratelens.functions.numeric import fixed2, round2
from ratelens.functions.time import year_utc
from ratelens.plans import ratings as R
from ratelens.plans.ratings import RatingsStar


def test_movie_mean_count_drops_unknown_movie(star):
    assert rows(R.movie_mean_count(star)) == [(10, "First Film (1990)", 4.17, 3)]


def test_movie_mean_by_title_exact_and_key_fallback(star):
    got = rows(R.movie_mean_by_title(star))
    assert got == [(99, "99", 2.0, 1), (10, "First Film (1990)", 12.5 / 3, 3)]


def test_best_movie_fallback_and_winner(star):
    none = rows(R.best_movie(star, 5))
    assert none == [(None, None, None, None, "No movies has at least 5 ratings.")]
    best = rows(R.best_movie(star, 3))
    assert best[0][:4] == (10, "First Film (1990)", 12.5 / 3, 3)
    assert best[0][4] == ("First Film (1990) is the highest rated movie with an average rating of 4.1666665 "
                          "among movies with at least 3 ratings.")


def test_best_movie_tie_goes_to_lowest_id(spark):
    ratings = spark.createDataFrame(
        [(1, 7, 4.0, 0), (2, 7, 4.0, 0), (1, 3, 4.0, 0), (2, 3, 4.0, 0), (1, 5, 1.0, 0), (2, 5, 1.0, 0)],
        "user_key int, movie_id int, rating double, ts long")
    movies = spark.createDataFrame([(7, "Seven", "A"), (3, "Three", "A"), (5, "Five", "A")],
                                   "movie_id int, title string, genres string")
    star = RatingsStar(ratings, movies, None)
    assert rows(R.best_movie(star, 2), "movie_id")[0] == (3,)
    assert rows(R.best_movie(star, 2, rounded=True), "movie_id")[0] == (3,)


def test_genre_means_from_exploded_dimension(star):
    assert rows(R.genre_mean_count(star)) == [("Crime", 4.17, 3), ("Drama", 4.17, 3)]
    assert rows(R.genre_mean_desc(star)) == [("Crime", 4.17), ("Drama", 4.17)]


def test_genre_empty_parts_dropped(spark):
    ratings = spark.createDataFrame([(1, 1, 4.0, 0)], "user_key int, movie_id int, rating double, ts long")
    movies = spark.createDataFrame([(1, "T", "|Drama||Crime|")], "movie_id int, title string, genres string")
    assert rows(R.genre_mean_count(RatingsStar(ratings, movies, None)), "genre") == [("Crime",), ("Drama",)]


def test_gender_wide_unknown_counts_as_female(star):
    got = rows(R.gender_wide(star))
    assert got == [(99, "99", 2.0, 0.0), (10, "First Film (1990)", 3.5, 4.5)]


def test_gender_long_unknown_group(star):
    got = rows(R.gender_long(star))
    assert got == [(10, "First Film (1990)", "F", 5.0, 1), (10, "First Film (1990)", "M", 3.5, 1),
                   (10, "First Film (1990)", "Unknown", 4.0, 1), (99, "Unknown", "M", 2.0, 1)]


def test_age_wide_four_groups_with_na(star):
    got = rows(R.age_wide_text(star, "four"))
    assert got == [(99, "99", "2.00", "NA", "NA", "NA"), (10, "First Film (1990)", "3.50", "NA", "NA", "5.00")]


def test_age_long_five_groups_inner(star):
    got = rows(R.age_long(star, "five"))
    assert got == [(10, "First Film (1990)", "Under18", 3.5, 1), (10, "First Film (1990)", "50+", 5.0, 1)]


def test_occupation_unknowns(star):
    got = rows(R.occupation_mean(star))
    assert got == [(7, "Unknown", 5.0, 1), (None, "Unknown", 4.0, 1), (1, "Programmer", 2.75, 2)]


def test_year_mean_utc_boundary(star):
    assert rows(R.year_mean(star)) == [(2019, 5.0, 1), (2020, 3.17, 3)]


AGES = [17, 18, 19, 25, 26, 35, 36, 50, 51, None]


@pytest.mark.parametrize("preset,expected", [
    ("four", ["0-18", "0-18", "18-35", "18-35", "18-35", "18-35", "35-50", "35-50", "50+", None]),
    ("five", ["Under18", "18-25", "18-25", "18-25", "26-35", "26-35", "36-50", "36-50", "50+", None]),
])
def test_age_buckets(spark, preset, expected):
    df = spark.createDataFrame([(a,) for a in AGES], "age int")
    assert [r[0] for r in df.select(bucketize("age", preset)).collect()] == expected


def test_round_half_up_on_decimal_value(spark):
    df = spark.createDataFrame([(3.775,), (2.675,), (1.005,), (3.625,), (75.5 / 20,), (None,)], "x double")
    assert [r[0] for r in df.select(round2("x")).collect()] == [3.78, 2.68, 1.01, 3.63, 3.78, None]
    assert [r[0] for r in df.select(fixed2("x")).collect()] == ["3.78", "2.68", "1.01", "3.63", "3.78", None]


def test_year_utc_epoch_edges(spark):
    df = spark.createDataFrame([(1577836799,), (1577836800,), (-1,), (0,)], "ts long")
    assert [r[0] for r in df.select(year_utc("ts")).collect()] == [2019, 2020, 1969, 1970]


def test_year_independent_of_session_zone(spark):
    df = spark.createDataFrame([(1577836799,)], "ts long")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
        assert df.select(year_utc("ts")).first()[0] == 2019
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_epoch_seconds_of_wall_clock_timestamp(spark):
    from ratelens.functions.time import epoch_seconds
    df = spark.sql("select timestamp_ntz'2019-12-31 23:59:59' as t, timestamp_ntz'1969-12-31 23:59:59' as u")
    assert df.select(epoch_seconds("t"), epoch_seconds("u")).first() == (1577836799, -1)


def test_duplicate_titles_stay_separate(spark):
    ratings = spark.createDataFrame([(1, 1, 4.0, 0), (1, 2, 2.0, 0)], "user_key int, movie_id int, rating double, ts long")
    movies = spark.createDataFrame([(1, "Same", "A"), (2, "Same", "A")], "movie_id int, title string, genres string")
    got = rows(R.movie_mean_by_title(RatingsStar(ratings, movies, None)))
    assert got == [(1, "Same", 4.0, 1), (2, "Same", 2.0, 1)]


def test_null_keys_go_round_the_join(spark):
    from ratelens.operators.lookup import lookup, lookup_past_nulls
    fact = spark.createDataFrame([(1, "x"), (None, "y"), (3, "z"), (None, "y")], "k int, f string")
    dim = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    got = sorted(rows(lookup_past_nulls(fact, dim, "k"), "k", "f", "v"), key=str)
    assert got == sorted(rows(lookup(fact, dim, "k"), "k", "f", "v"), key=str)
    assert got == [(1, "x", "a"), (3, "z", None), (None, "y", None), (None, "y", None)]


def test_support_thresholds_at_4_5_49_50(spark):
    counts = {1: 4, 2: 5, 3: 49, 4: 50}
    means = {1: 5.0, 2: 4.0, 3: 4.5, 4: 3.0}
    data = [(u, m, means[m], 0) for m, c in counts.items() for u in range(c)]
    ratings = spark.createDataFrame(data, "user_key int, movie_id int, rating double, ts long")
    movies = spark.createDataFrame([(m, f"M{m}", "A") for m in counts], "movie_id int, title string, genres string")
    star = RatingsStar(ratings, movies, None)
    assert rows(R.best_movie(star, 5), "movie_id", "n")[0] == (3, 49)        # 4 ratings is too few
    assert rows(R.best_movie(star, 50, rounded=True), "movie_id", "n")[0] == (4, 50)  # 49 is too few
    assert rows(R.best_movie(star, 51), "result")[0] == ("No movies has at least 51 ratings.",)


def test_missing_gender_and_age_cells_in_reports(spark, write_files):
    from ratelens.sources import files as S
    f = write_files({"users.txt": "1,M,30,1\n2,,40,1\n3,F,,1\n", "movies.txt": "10,Film (2000),Drama\n",
                     "ratings.txt": "1,10,4.0,0\n2,10,2.0,0\n3,10,3.0,0\n"})
    star = RatingsStar(S.read_ratings(spark, f["ratings.txt"]), S.read_movies(spark, f["movies.txt"]),
                       S.read_users(spark, f["users.txt"]))
    # missing gender: not 'M', so female in the wide form, and of no name in the long form
    assert rows(R.gender_wide(star), "male_avg", "female_avg") == [(4.0, 2.5)]
    assert sorted(rows(R.gender_long(star), "gender", "n")) == [("", 1), ("F", 1), ("M", 1)]
    # missing age: the user drops out of the age reports
    assert rows(R.age_long(star, "five"), "age_group", "n") == [("26-35", 1), ("36-50", 1)]


def test_id_order_option(spark):
    ratings = spark.createDataFrame([(1, 999, 4.0, 0), (1, 1010, 3.0, 0)], "user_key int, movie_id int, rating double, ts long")
    movies = spark.createDataFrame([(999, "A", "x"), (1010, "B", "x")], "movie_id int, title string, genres string")
    users = spark.createDataFrame([(1, 1, "M", 30, 1)], "user_key int, user_id int, gender string, age int, occupation_id int")
    star = RatingsStar(ratings, movies, users)
    assert rows(R.gender_long(star), "movie_id") == [(999,), (1010,)]
    assert rows(R.gender_long(star, id_order="string"), "movie_id") == [(1010,), (999,)]
    assert rows(R.age_long(star, id_order="string"), "movie_id") == [(1010,), (999,)]
    with pytest.raises(ValueError):
        R.gender_long(star, id_order="alpha")


def test_movie_report_ends_with_result_line(star):
    got = rows(R.movie_report_with_result(star))
    assert got == [("99", "Average rating: 2.0 (Total ratings: 1)"),
                   ("First Film (1990)", "Average rating: 4.1666665 (Total ratings: 3)"),
                   ("RESULT", "No movies has at least 5 ratings.")]


def test_fixed_width_report_formats(star):
    from ratelens.functions import render as P
    gender = [r[0] for r in P.fixed_width(R.gender_long(star), P.GENDER_ROW).collect()]
    assert gender[0] == f"{'10':<7} | {'First Film (1990)':<60} | {'F':<6} | {'5.0':<10} | {'1':<10}"
    occ = [r[0] for r in P.fixed_width(R.occupation_mean(star), P.OCCUPATION_ROW).collect()]
    assert occ[1] == f"{'Unknown':<5} | {'Unknown':<20} | {'4.00':<10} | {'1':<12}"


def test_means_are_rounded_once(spark):
    """20,001 ratings that sum to 60,103: the mean 3.00499975 is 3.0."""
    import dataclasses
    from ratelens.plans import ratings as R
    ratings = spark.range(20001).selectExpr("id as user_key", "1L as movie_id", "case when id < 100 then 4.0D when id < 20000 then 3.0D else 3.0D end as rating", "0L as ts")
    total = ratings.selectExpr("sum(rating)").first()[0]
    assert total == 60103.0
    movies = spark.createDataFrame([(1, "A", "g")], "movie_id long, title string, genres string")
    star = R.RatingsStar(ratings, movies, spark.createDataFrame([], "user_key long, gender string, age int, occupation_id long"))
    assert [tuple(r) for r in R.year_mean(star).collect()] == [(1970, 3.0, 20001)]
    assert R.genre_mean_count(star).first().avg_rating == 3.0
    tie = spark.range(40).selectExpr("id as user_key", "1L as movie_id", "case when id < 27 then 3.0D else 2.0D end as rating", "0L as ts")
    assert R.movie_mean_count(dataclasses.replace(star, ratings=tie)).first().avg_rating == 2.68  # 107 / 40


def test_movie_sentence_shows_the_unrounded_mean(spark, star):
    from ratelens.functions.render import movie_sentence
    from ratelens.plans import ratings as R
    got = {r.title: r.value for r in movie_sentence(R.movie_mean_by_title(star)).collect()}
    assert got["First Film (1990)"] == "Average rating: 4.1666665 (Total ratings: 3)"
    report = [tuple(r) for r in R.movie_report_with_result(star, min_n=3).collect()]
    assert report[-1] == ("RESULT", "First Film (1990) is the highest rated movie with an average rating of 4.1666665 "
                                    "among movies with at least 3 ratings.")
    assert dict(report)["99"] == "Average rating: 2.0 (Total ratings: 1)"
    none = R.RatingsStar(star.ratings.where("false"), star.movies, star.users)
    assert [tuple(r) for r in R.movie_report_with_result(none).collect()] == [("RESULT", "No movies has at least 5 ratings.")]
