"""Randomised checks of the operators against brute-force Python."""

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from ratelens.functions.buckets import AGE_GROUPS_4, AGE_GROUPS_5, bucketize
from ratelens.functions.numeric import round2
from ratelens.operators.aggregate import mean_count
from ratelens.operators.topk import top_k_per_group

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

ratings_rows = st.lists(st.tuples(st.integers(0, 6), st.sampled_from([0.5 * k for k in range(1, 11)])),
                        min_size=1, max_size=60)


def py_round2(x: float) -> float:
    return float(Decimal(repr(x)).quantize(Decimal("0.01"), ROUND_HALF_UP))


@SETTINGS
@given(ratings_rows)
def test_mean_count_matches_python(spark, data):
    df = spark.createDataFrame(data, "movie_id int, rating double")
    got = {r["movie_id"]: (r["avg_rating"], r["n"]) for r in mean_count(df, "movie_id").collect()}
    s, n = defaultdict(float), defaultdict(int)
    for m, r in data:
        s[m] += r
        n[m] += 1
    assert got == {m: (py_round2(s[m] / n[m]), n[m]) for m in s}


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abc"), st.sampled_from(["x", "y", "z", "w", "v"]),
                          st.integers(0, 5)), min_size=1, max_size=40), st.integers(1, 3))
def test_top_k_per_group_matches_python(spark, data, k):
    df = spark.createDataFrame(data, "g string, w string, n int")
    got = sorted(tuple(r) for r in top_k_per_group(df, "g", [F.desc("n"), "w", "n"], k).collect())
    want = []
    for g in {d[0] for d in data}:
        want += sorted((d for d in data if d[0] == g), key=lambda d: (-d[2], d[1], d[2]))[:k]
    assert got == sorted(want)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-5, 120)), min_size=1, max_size=30))
def test_bucketize_matches_python(spark, ages):
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = [tuple(r) for r in df.select(bucketize("age", "four"), bucketize("age", "five")).collect()]

    def four(a):
        return None if a is None else "0-18" if a <= 18 else "18-35" if a <= 35 else "35-50" if a <= 50 else "50+"

    def five(a):
        return (None if a is None else "Under18" if a < 18 else "18-25" if a <= 25 else "26-35" if a <= 35
                else "36-50" if a <= 50 else "50+")
    assert got == [(four(a), five(a)) for a in ages]
    assert AGE_GROUPS_4.labels == ["0-18", "18-35", "35-50", "50+"]
    assert AGE_GROUPS_5.labels == ["Under18", "18-25", "26-35", "36-50", "50+"]


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 10_000), st.integers(1, 400)), min_size=1, max_size=40))
def test_round2_half_up_on_ratios(spark, pairs):
    df = spark.createDataFrame([(a / b,) for a, b in pairs], "x double")
    got = [r[0] for r in df.select(round2("x")).collect()]
    assert got == [(200 * a + b) // (2 * b) / 100 for a, b in pairs]  # half-up in whole numbers


def _py_clean(s: str) -> str:
    """Independent Python version of the cleaning (regex module, Unicode \\b)."""
    import regex
    from ratelens.functions.text import STOPWORD_PATTERN
    s = regex.sub(STOPWORD_PATTERN, "", s.lower())
    s = regex.sub(r"[!-/:-@\[-`{-~]", " ", s)
    s = regex.sub(r"[ \t\n\x0b\f\r]{2,}", " ", s)
    return s.strip("".join(chr(c) for c in range(0x21)))


_WORDS = ["là", "của", "có", "có thể", "chúng tôi", "bao giờ", "bao", "giờ", "hôm nay", "hôm", "ba", "bàn",
          "Phòng", "rất", "sạch", "tốt", "ừ", "ừm", "à", "ở", "đó", "nhé", "khách", "sạn", "x", "12"]
_SEPS = [" ", "  ", ", ", ".", "!", "\t", " – ", "“", "”", "(", ")", "*", "_", "-"]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(_WORDS), st.sampled_from(_SEPS)), min_size=0, max_size=25))
def test_clean_review_matches_python_regex(spark, parts):
    from ratelens.functions.text import clean_review
    text = "".join(w + s for w, s in parts)
    got = spark.createDataFrame([(text,)], "r string").select(clean_review(F.col("r"))).first()[0]
    assert got == _py_clean(text)


_REVIEW_WORDS = ["phòng", "sạch", "ồn", "vị", "ab", "x", "khách*", "(tốt)", '"giá"', "ΩΩ", "ß", "12"]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["ROOMS", "HOTEL", None]), st.sampled_from(["A", None]),
                          st.lists(st.sampled_from(_REVIEW_WORDS), max_size=8)), min_size=1, max_size=12))
def test_word_reports_match_python(spark, data):
    import re
    from collections import Counter

    from ratelens.plans import reviews as V
    rowsin = [(i, " ".join(ws), a, c, "positive") for i, (c, a, ws) in enumerate(data)]
    df = spark.createDataFrame(rowsin, "id int, review string, aspect string, category string, sentiment string")

    def toks(s):
        return [t for t in re.split(r'[ ",()*]', s.lower()) if t]
    freq = Counter(t for _, r, _, _, _ in rowsin for t in toks(r))
    want_top = sorted(freq.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert [tuple(r) for r in V.top_words(df, 5).collect()] == want_top

    keep = re.compile(r"[^a-zA-Zà-ỹ0-9]")
    per = Counter()
    for _, r, a, c, _ in rowsin:
        for t in toks(r):
            w = keep.sub("", t)
            if w and a is not None:
                per[(c, w)] += 1
            elif w:
                per.setdefault((c, w), 0)
    want = []
    for cat in {k[0] for k in per}:
        items = sorted(((w, n) for (c, w), n in per.items() if c == cat), key=lambda x: (-x[1], x[0]))[:5]
        want += [(cat, w, n) for w, n in items]
    got = [tuple(r) for r in V.top_symbol_stripped_words(df, 5).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 6), st.integers(1, 4), st.sampled_from([1.0, 2.5, 3.0, 4.5, 5.0])),
                min_size=1, max_size=40))
def test_user_reports_match_python(spark, data):
    from ratelens.plans import ratings as R
    # users 1..4 exist (5, 6 unknown); movies 1..3 exist (4 unknown); occupation 9 unknown
    users = [(1, 1, "M", 20, 1), (2, 2, "F", 40, 2), (3, 3, None, 60, 9), (4, 4, "M", None, 1)]
    movies = [(1, "A", "Drama|Crime"), (2, "B", "Drama"), (3, "C", "|Comedy|")]
    occ = [(1, "Programmer"), (2, "Doctor")]
    star = R.RatingsStar(
        spark.createDataFrame([(u, m, r, 0) for u, m, r in data], "user_key int, movie_id int, rating double, ts long"),
        spark.createDataFrame(movies, "movie_id int, title string, genres string"),
        spark.createDataFrame(users, "user_key int, user_id int, gender string, age int, occupation_id int"),
        spark.createDataFrame(occ, "occupation_id int, occupation string"))
    ugender = {u[0]: u[2] for u in users}
    uocc = {u[0]: u[4] for u in users}
    titles = {m[0]: m[1] for m in movies}
    occname = dict(occ)

    def means(pairs):
        s, n = defaultdict(float), defaultdict(int)
        for k, r in pairs:
            s[k] += r
            n[k] += 1
        return {k: (py_round2(s[k] / n[k]), n[k]) for k in s}

    want_long = means(((m, (ugender[u] or "") if u in ugender else "Unknown"), r) for u, m, r in data)
    got_long = {(r["movie_id"], r["gender"]): (r["avg_rating"], r["n"]) for r in R.gender_long(star).collect()}
    assert got_long == want_long
    male = means((m, r) for u, m, r in data if ugender.get(u) == "M")
    female = means((m, r) for u, m, r in data if ugender.get(u) != "M")
    got_wide = {r["movie_id"]: (r["title"], r["male_avg"], r["female_avg"]) for r in R.gender_wide(star).collect()}
    assert got_wide == {m: (titles.get(m, str(m)), male.get(m, (0.0,))[0], female.get(m, (0.0,))[0])
                        for m in {d[1] for d in data}}
    want_occ = means(((uocc.get(u), occname.get(uocc.get(u), "Unknown")), r) for u, m, r in data)
    got_occ = {(r["occupation_id"], r["occupation"]): (r["avg_rating"], r["n"]) for r in R.occupation_mean(star).collect()}
    assert got_occ == want_occ
    genres = {1: ["Drama", "Crime"], 2: ["Drama"], 3: ["Comedy"]}
    want_genre = means((g, r) for u, m, r in data for g in genres.get(m, []))
    got_genre = {r["genre"]: (r["avg_rating"], r["n"]) for r in R.genre_mean_count(star).collect()}
    assert got_genre == want_genre


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 6), st.integers(1, 4), st.sampled_from([1.0, 2.0, 3.5, 5.0])),
                min_size=1, max_size=40), st.integers(1, 6))
def test_age_and_best_reports_match_python(spark, data, min_n):
    from ratelens.plans import ratings as R
    users = [(1, 1, "M", 17, 1), (2, 2, "F", 18, 1), (3, 3, "F", 36, 1), (4, 4, "M", None, 1), (5, 5, "F", 51, 1)]
    movies = [(1, "A", "x"), (2, "B", "x"), (3, "C", "x")]
    star = R.RatingsStar(
        spark.createDataFrame([(u, m, r, 0) for u, m, r in data], "user_key int, movie_id int, rating double, ts long"),
        spark.createDataFrame(movies, "movie_id int, title string, genres string"),
        spark.createDataFrame(users, "user_key int, user_id int, gender string, age int, occupation_id int"))
    age = {u[0]: u[3] for u in users}
    five = {17: "Under18", 18: "18-25", 36: "36-50", 51: "50+"}
    four = {17: "0-18", 18: "0-18", 36: "35-50", 51: "50+"}

    def means(pairs):
        s, n = defaultdict(float), defaultdict(int)
        for k, r in pairs:
            s[k] += r
            n[k] += 1
        return {k: (py_round2(s[k] / n[k]), n[k]) for k in s}

    known = [(u, m, r) for u, m, r in data if age.get(u) is not None]
    want_long = means(((m, five[age[u]]), r) for u, m, r in known if m <= 3)
    got_long = {(r["movie_id"], r["age_group"]): (r["avg_rating"], r["n"]) for r in R.age_long(star).collect()}
    assert got_long == want_long
    wide = means(((m, four[age[u]]), r) for u, m, r in known)
    got_wide = {r["movie_id"]: tuple(r)[2:] for r in R.age_wide_text(star, "four").collect()}
    want_wide = {m: tuple(f"{wide[(m, g)][0]:.2f}" if (m, g) in wide else "NA"
                          for g in ("0-18", "18-35", "35-50", "50+"))
                 for m in {m for _, m, _ in known}}
    assert got_wide == want_wide

    stats = means((m, r) for u, m, r in data if m <= 3)
    pool = [(m, a, n) for m, (a, n) in stats.items() if n >= min_n]
    best = rows(R.best_movie(star, min_n, rounded=True), "movie_id")[0][0]
    assert best == (min(pool, key=lambda t: (-t[1], t[0]))[0] if pool else None)
