"""Cross-report invariants on the driver tables (sf0.001)."""

from collections import defaultdict

import pytest

from conftest import SF_SMALL
from ratelens.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def q(spark):
    cache = {}

    def get(name):
        if name not in cache:
            cache[name] = [r.asDict() for r in QUERIES[name](spark, SF_SMALL).collect()]
        return cache[name]
    return get


def test_counts_sum_to_all_ratings(spark, q):
    total = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    for name in ("gender_long_unknown", "occupation_mean", "year_mean", "movie_mean_by_title"):
        assert sum(r["n"] for r in q(name)) == total, name
    named = {r["movie_id"] for r in q("movie_mean_count")}  # ratings of unknown movies drop out of this one
    assert 0 < sum(r["n"] for r in q("movie_mean_by_title") if r["movie_id"] not in named) < total
    assert sum(r["n"] for r in q("movie_mean_count")) == sum(r["n"] for r in q("movie_mean_by_title") if r["movie_id"] in named)
    assert len(q("ratings_union_all")) == total


def test_long_forms_reproduce_movie_means(q):
    exact = {r["movie_id"]: r["avg_rating"] for r in q("movie_mean_by_title")}
    for name in ("gender_long_unknown",):
        s, n = defaultdict(float), defaultdict(int)
        for r in q(name):
            s[r["movie_id"]] += r["avg_rating"] * r["n"]
            n[r["movie_id"]] += r["n"]
        for m in s:
            assert abs(s[m] / n[m] - exact[m]) <= 0.005 + 1e-9, (name, m)


def test_gender_wide_agrees_with_long(q):
    longf = {(r["movie_id"], r["gender"]): (r["avg_rating"], r["n"]) for r in q("gender_long_unknown")}
    assert any(g == "Unknown" for _, g in longf)
    for r in q("gender_wide"):
        assert r["male_avg"] == longf.get((r["movie_id"], "M"), (0.0, 0))[0]
        other = [longf[k] for k in ((r["movie_id"], "F"), (r["movie_id"], "Unknown")) if k in longf]
        mean = sum(a * n for a, n in other) / sum(n for _, n in other) if other else 0.0
        assert abs(r["female_avg"] - mean) <= 0.01 + 1e-9  # unknown users count as female


def test_unknown_rows_reach_the_reports(q):
    occupations = [(r["occupation_id"], r["occupation"]) for r in q("occupation_mean")]
    assert (None, "Unknown") in occupations and any(i is not None and o == "Unknown" for i, o in occupations)
    assert any(r["title"] == "Unknown" for r in q("gender_long_unknown"))
    assert any(r["title"] == str(r["movie_id"]) for r in q("gender_wide"))


def test_genre_counts_exceed_ratings_through_explode(q):
    assert sum(r["n"] for r in q("genre_mean_count")) > sum(r["n"] for r in q("movie_mean_count"))


def test_category_and_aspect_counts_agree(q):
    parsed = q("reviews_parse")
    with_id = sum(1 for r in parsed if r["id"] is not None)
    assert sum(r["total_comments"] for r in q("category_count")) == with_id
    assert sum(r["total_comments"] for r in q("aspect_count")) == with_id


def test_sentiment_words_within_all_sentiment_words(q):
    total = {(r["category"], r["word"]): r["cnt"] for r in q("top_words_category")}
    pos = {(r["category"], r["word"]): r["freq"] for r in q("top_words_category_positive")}
    neg = {(r["category"], r["word"]): r["freq"] for r in q("top_words_category_negative")}
    for key in set(total) & set(pos) & set(neg):
        assert pos[key] + neg[key] <= total[key]


def test_best_movie_is_top_of_ranked_report(q):
    best = q("best_movie_min5_rounded")[0]
    ranked = [r for r in q("movie_mean_count") if r["n"] >= 5]
    top = max(r["avg_rating"] for r in ranked)
    assert best["avg_rating"] == top
    assert best["movie_id"] == min(r["movie_id"] for r in ranked if r["avg_rating"] == top)
