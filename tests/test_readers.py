import pytest
from pyspark.sql import functions as F

from conftest import rows
from ratelens.sources import files as S


def test_ratings_drop_bad_header_blank_and_spaces(spark, star_files):
    f = star_files
    df = S.read_ratings(spark, [f["ratings_1.txt"], f["ratings_2.txt"]])
    got = sorted(rows(df, "user_id", "movie_id", "rating", "ts"))
    assert got == [(1, 10, 3.5, 1577836800), (1, 99, 2.0, 1600000000),
                   (4, 10, 5.0, 1577836799), (9, 10, 4.0, 1600000000)]


def test_ratings_null_policy_keeps_row(spark, star_files):
    df = S.read_ratings(spark, star_files["ratings_1.txt"], on_bad="null")
    got = sorted(rows(df, "user_id", "movie_id", "rating", "ts"), key=str)
    assert (2, 11, None, 5) in got
    assert (None, None, None, None) in got  # the short line "bad"
    assert len(got) == 3  # the blank line is skipped


def test_ratings_fail_policy_raises(spark, star_files):
    df = S.read_ratings(spark, star_files["ratings_1.txt"], on_bad="fail")
    with pytest.raises(Exception):
        df.collect()


def test_bad_policy_name(spark, star_files):
    with pytest.raises(ValueError):
        S.read_ratings(spark, star_files["ratings_1.txt"], on_bad="skip")


def test_pruned_read_is_consistent(spark, star_files):
    f = star_files
    df = S.read_ratings(spark, [f["ratings_1.txt"], f["ratings_2.txt"]])
    assert df.count() == df.select("movie_id").count() == len(df.collect()) == 4


def test_movies_titles_keep_commas_and_two_field_lines(spark, write_files):
    f = write_files({"movies.txt": "10, First Film (1990), Drama|Crime\n12,Hello, World (2000),Comedy||\n"
                                   "13, Only Title\nxx, Bad Id, Drama\n"})
    got = sorted(rows(S.read_movies(spark, f["movies.txt"])))
    assert got == [(10, "First Film (1990)", "Drama|Crime"), (12, "Hello, World (2000)", "Comedy||"),
                   (13, "Only Title", None)]


def test_users_missing_cells_are_null(spark, write_files):
    f = write_files({"users.txt": "1,M,17,1\n2,,,3\n3,F\n"})
    got = sorted(rows(S.read_users(spark, f["users.txt"]), "user_id", "gender", "age", "occupation_id"))
    assert got == [(1, "M", 17, 1), (2, None, None, 3), (3, "F", None, None)]


def test_loose_long_truncates_decimal_strings(spark):
    from pyspark.sql import functions as F
    from ratelens.functions.text import loose_long
    df = spark.createDataFrame([("12",), ("12.5",), (" 7 ",), ("x",), (None,), ("3000000000",)], "s string")
    assert [r[0] for r in df.select(loose_long(F.col("s"))).collect()] == [12, 12, 7, None, None, 3000000000]


def test_review_lines_parse(spark, write_files):
    text = ("id;review;aspect;category;sentiment\n"
            "7;Phòng đẹp; sạch, và tốt!;CLEANLINESS;ROOMS;positive\n"
            "8;Không có thể ngủ (ồn);COMFORT;ROOMS; Negative\n"
            "x;bad id;GENERAL;HOTEL;neutral\n"
            "junk line without separators\n")
    f = write_files({"hotel-review.csv": text})
    got = rows(S.read_reviews_raw(spark, f["hotel-review.csv"]))
    assert got == [
        (7, "Phòng đẹp; sạch, và tốt!", "CLEANLINESS", "ROOMS", "positive"),
        (8, "Không có thể ngủ (ồn)", "COMFORT", "ROOMS", " Negative"),
        (None, "bad id", "GENERAL", "HOTEL", "neutral"),
        (None, None, None, None, None),
    ]


def test_reviews_tsv_empty_and_missing_fields(spark, write_files):
    f = write_files({"part-r-00000": "1\tgood room\tGENERAL\tHOTEL\tpositive\n2\t\tCOMFORT\n"})
    got = rows(S.read_reviews_tsv(spark, f["part-r-00000"]))
    assert got == [("1", "good room", "GENERAL", "HOTEL", "positive"), ("2", None, "COMFORT", None, None)]


def test_stopword_pattern_file(spark, write_files):
    f = write_files({"stopwords_regex.txt": "\\b(là|của)\\b\nignored\n"})
    assert S.read_stopword_pattern(spark, f["stopwords_regex.txt"]) == "\\b(là|của)\\b"


def test_filename_routed_scan(spark, write_files):
    f = write_files({"users.txt": "1, M, 17, 1\n", "ratings_1.txt": "1, 10, 4.0, 0\n1, 11, 3.0, 0\n",
                     "movies.txt": "10,A (1990),Drama\n"})
    folder = f["users.txt"].rsplit("/", 1)[0]
    parts = S.read_routed(spark, folder, S.route_parsers())
    assert rows(parts["users"], "user_id", "gender", "age", "occupation_id") == [(1, "M", 17, 1)]
    assert sorted(rows(parts["ratings"], "movie_id", "rating")) == [(10, 4.0), (11, 3.0)]
    assert rows(parts["movies"]) == [(10, "A (1990)", "Drama")]


def test_driver_tables_roles(spark):
    from conftest import SF_SMALL
    from ratelens.sources import tables as T
    r = T.ratings(spark, SF_SMALL)
    assert r.columns == ["user_key", "movie_id", "rating", "ts"]
    u = T.users(spark, SF_SMALL)
    assert set(u.columns) == {"user_key", "user_id", "gender", "age", "occupation_id"}
    assert r.count() == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    lines = T.review_lines(spark, SF_SMALL)
    assert lines.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count() + 1


EDGE_LINES = [
    "7;Phòng đẹp; sạch, và tốt!;CLEANLINESS;ROOMS;positive", "1;r;a;c;s", "1;;a;c;s", "1;r;a;c;",
    ";r;a;c;s", "1;r;;c;s", "1;r;a;c;s;", "1;a;b;c;d;e;f;g", "1;r\u2028x;a;c;s", "1;r;a;c;s\u2028",
    "1\n2;r;a;c;s", "1;r\rx;a;c;s", "1;r;a;c;s\n", "1;r\u0085;a;c;s", "x;bad id;GENERAL;HOTEL;neutral",
    "junk", "", ";;;;", "1;;;;;", "12.5; r ;A ;C; s ", "id;looks;like;a;header",
]


def test_split_parse_equals_regex_groups(spark):
    """The one-regex parse gives exactly the five regex groups (or NULLs)."""
    from collections import Counter

    from conftest import SF_SMALL
    from ratelens.functions.text import extract_or_null, full_match, loose_long
    from ratelens.sources.tables import review_lines
    lines = review_lines(spark, SF_SMALL).unionByName(
        spark.createDataFrame([(e,) for e in EDGE_LINES], "line string"))
    rx, v = S.REVIEW_LINE_REGEX, F.col("line")
    by_regex = lines.where(~full_match(v, S.REVIEWS_HEADER_REGEX)).select(
        loose_long(extract_or_null(v, rx, 1)).alias("id"),
        *[extract_or_null(v, rx, i).alias(c) for i, c in [(2, "review"), (3, "aspect"), (4, "category"),
                                                          (5, "sentiment")]])
    a = Counter(tuple(r) for r in by_regex.collect())
    b = Counter(tuple(r) for r in S.parse_review_lines(lines).collect())
    assert a == b
    assert sum(a.values()) == lines.count() - 2  # the header and the header-like edge line


def test_ids_beyond_32_bits_are_kept(spark, write_files):
    f = write_files({"r.txt": "3000000000,3000000001,4.0,0\n", "rv.csv": "id;x\n3000000000;good room;A;C;positive\n"})
    assert rows(S.read_ratings(spark, f["r.txt"]), "user_id", "movie_id") == [(3000000000, 3000000001)]
    from ratelens.plans import reviews as V
    parsed = S.read_reviews_raw(spark, f["rv.csv"])
    assert rows(V.count_by(parsed, "category")) == [("C", 1)]
    assert ("C", "good", 1) in rows(V.top_words_for_sentiment(V.clean_reviews(parsed), "positive"))


def test_comma_file_ids_are_whole_numbers(spark, write_files):
    f = write_files({"r.txt": "1,10.5,4.0,0\n1,10,NaN,0\n1, 11 ,3.0,0\n", "m.txt": "10.5,Half,Drama\n"})
    got = rows(S.read_ratings(spark, f["r.txt"]), "movie_id", "rating")
    assert [g[0] for g in got] == [10, 11] and got[0][1] != got[0][1]  # NaN is a number
    assert rows(S.read_movies(spark, f["m.txt"])) == []


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("line", ["1,x,4.0,0", "1,10.5,4.0,0", "1,10,4.0", "1,10,4.0,y"])
def test_fail_policy_holds_under_pruning(spark, write_files, ansi, line):
    f = write_files({"r.txt": f"1,10,4.0,0\n{line}\n"})
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="bad input line"):
            S.read_ratings(spark, f["r.txt"], on_bad="fail").select("rating").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_fail_policy_passes_good_lines(spark, star_files):
    f = star_files
    assert S.read_users(spark, f["users.txt"], on_bad="fail").count() == 3
    assert S.read_movies(spark, f["movies.txt"], on_bad="fail").count() == 2
    assert S.read_occupations(spark, f["occupation.txt"], on_bad="fail").count() == 2


def test_routed_movies_keep_commas_and_occupations_have_a_route(spark, write_files):
    f = write_files({"movies.txt": "10, Film, The (1990), Drama|Crime\n", "occupation.txt": "1,Programmer, senior\n"})
    parts = S.read_routed(spark, f["movies.txt"].rsplit("/", 1)[0], S.route_parsers())
    assert rows(parts["movies"]) == [(10, "Film, The (1990)", "Drama|Crime")]
    assert rows(parts["occupation"]) == [(1, "Programmer, senior")]


def test_last_row_of_a_repeated_key(spark, write_files):
    from ratelens.plans import ratings as R
    f = write_files({"users.txt": "1,M,17,1\n2,F,20,2\n1,F,40,2\n", "movies.txt": "10,Old,Drama\n10,New,Drama\n",
                     "occupation.txt": "2,Clerk\n2,Doctor\n", "r.txt": "1,10,4.0,0\n2,10,2.0,0\n,10,1.0,0\n"})
    users = S.read_users(spark, f["users.txt"], last=True)
    assert sorted(rows(users, "user_id", "gender", "age", "occupation_id")) == [(1, "F", 40, 2), (2, "F", 20, 2)]
    star = R.RatingsStar(S.read_ratings(spark, f["r.txt"]), S.read_movies(spark, f["movies.txt"], last=True), users,
                         S.read_occupations(spark, f["occupation.txt"], last=True))
    assert rows(R.gender_long(star)) == [(10, "New", "F", 3.0, 2), (10, "New", "Unknown", 1.0, 1)]
    assert rows(R.occupation_mean(star)) == [(2, "Doctor", 3.0, 2), (None, "Unknown", 1.0, 1)]
    assert [r[3] for r in rows(R.movie_mean_count(star))] == [3]


def test_empty_gender_is_not_unknown(spark, write_files):
    from ratelens.plans import ratings as R
    f = write_files({"users.txt": "1,,17,1\n", "movies.txt": "10,A,Drama\n", "r.txt": "1,10,4.0,0\n2,10,2.0,0\n"})
    star = R.RatingsStar(S.read_ratings(spark, f["r.txt"]), S.read_movies(spark, f["movies.txt"]), S.read_users(spark, f["users.txt"]))
    assert rows(R.gender_long(star)) == [(10, "A", "", 4.0, 1), (10, "A", "Unknown", 2.0, 1)]
    assert rows(R.gender_long(R.enrich_users(star))) == rows(R.gender_long(star))


def test_the_last_row_follows_the_order_of_the_given_paths(spark, write_files):
    f = write_files({"a.txt": "1,Clerk\n2,Baker\n2,Cook\n", "b.txt": "1,Doctor\n"})
    by = {}
    for first, second in (("a.txt", "b.txt"), ("b.txt", "a.txt")):
        by[first] = dict(rows(S.read_occupations(spark, [f[first], f[second]], last=True)))
    assert by["a.txt"] == {1: "Doctor", 2: "Cook"} and by["b.txt"] == {1: "Clerk", 2: "Cook"}
    users = write_files({"z.txt": "1,M,17,1\n", "y.txt": "1,F,18,2\n"}, "u")
    got = S.read_users(spark, [users["z.txt"], users["y.txt"]], last=True)
    assert rows(got, "user_id", "gender") == [(1, "F")]


def test_a_route_scans_its_own_files_only(spark, write_files):
    f = write_files({"users_old.txt": "1,M,17,1\n", "my_ratings_1.txt": "1,10,4.0,0\n", "ratings_2.txt": "1,11,3.0,0\n",
                     "movies.txt": "10,A,Drama\n", "users_ratings.txt": "2,F,20,2\n"})
    folder = f["movies.txt"].rsplit("/", 1)[0]
    parts = S.read_routed(spark, folder, S.route_parsers())

    def names(df):
        return sorted(p.rsplit("/", 1)[-1] for p in df.inputFiles())
    assert names(parts["movies"]) == ["movies.txt"] and names(parts["users"]) == ["users_old.txt", "users_ratings.txt"]
    assert names(parts["ratings"]) == ["my_ratings_1.txt", "ratings_2.txt", "users_ratings.txt"]
    assert sorted(rows(parts["users"], "user_id")) == [(1,), (2,)]  # a name with both keys goes to the first route
    assert sorted(rows(parts["ratings"], "movie_id")) == [(10,), (11,)]
    assert rows(parts["occupation"]) == []
    odd = write_files({"x[1].txt": "1,Clerk\n", "x1.txt": "2,Cook\n"}, "odd")
    one = S.read_routed(spark, odd["x1.txt"].rsplit("/", 1)[0], {"x[1]": S.route_parsers()["occupation"]})
    assert rows(one["x[1]"]) == [(1, "Clerk")]
