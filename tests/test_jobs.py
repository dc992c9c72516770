"""Enriched ratings give the same reports; the job runners write every output."""

import pytest

from conftest import SF_SMALL, rows
from ratelens.plans import ratings as R

USER_REPORTS = [R.gender_wide, R.gender_long, lambda s: R.age_wide_text(s, "four"),
                lambda s: R.age_long(s, "five"), R.occupation_mean]


@pytest.mark.parametrize("report", USER_REPORTS)
def test_enriched_ratings_same_reports_fixture(star, report):
    assert rows(report(R.enrich_users(star))) == rows(report(star))


@pytest.mark.parametrize("report", USER_REPORTS)
def test_enriched_ratings_same_reports_tables(spark, report):
    from ratelens.plans.catalog import star as table_star
    s = table_star(spark, SF_SMALL)
    assert sorted(rows(report(R.enrich_users(s))), key=str) == sorted(rows(report(s)), key=str)


def test_rating_jobs_write_every_report(spark, tmp_path):
    from ratelens.plans.catalog import star as table_star
    from ratelens.plans.jobs import run_rating_jobs
    out = run_rating_jobs(table_star(spark, SF_SMALL), str(tmp_path / "ratings"))
    assert len(out) == 12
    for name, path in out.items():
        assert spark.read.text(path).count() > 0, name
    import glob
    folder = "/" + spark.sparkContext.getCheckpointDir().split(":", 1)[-1].lstrip("/")
    assert not glob.glob(f"{folder}/staged-rating_partials-*")


def test_command_line_ratings(spark, star_files, tmp_path):
    from ratelens.__main__ import main
    f = star_files
    out = main(["ratings", "--ratings", f["ratings_1.txt"], f["ratings_2.txt"], "--movies", f["movies.txt"],
                "--users", f["users.txt"], "--occupations", f["occupation.txt"], "--out", str(tmp_path / "o")],
               spark=spark)
    lines = sorted(r[0] for r in spark.read.text(out["occupation_mean"]).collect())
    assert lines == sorted(["7\tUnknown\t5.0\t1", "\tUnknown\t4.0\t1", "1\tProgrammer\t2.75\t2"])


def test_command_line_reviews(spark, write_files, tmp_path):
    from ratelens.__main__ import main
    f = write_files({"hotel-review.csv": "id;review;aspect;category;sentiment\n"
                                         "1;Phòng rất sạch!;CLEANLINESS;ROOMS;positive\n"
                                         "2;Phòng ồn, không ngủ được;COMFORT;ROOMS;negative\n",
                     "stopwords_regex.txt": "\\b(rất|được)\\b\n"})
    out = main(["reviews", "--input", f["hotel-review.csv"], "--stopwords", f["stopwords_regex.txt"],
                "--out", str(tmp_path / "o")], spark=spark)
    cleaned = sorted(r[0] for r in spark.read.text(out["reviews_clean"]).collect())
    assert cleaned == ["1\tphòng sạch\tCLEANLINESS\tROOMS\tpositive", "2\tphòng ồn không ngủ\tCOMFORT\tROOMS\tnegative"]


ALL_REPORTS = [R.movie_mean_count, R.movie_mean_by_title, lambda s: R.best_movie(s, 5), R.genre_mean_count, *USER_REPORTS, R.gender_wide,
               lambda s: R.age_wide(s, "four"), R.year_mean]


@pytest.mark.parametrize("report", ALL_REPORTS)
def test_reports_from_grouping_sets_equal_those_from_ratings(spark, star, report):
    from dataclasses import replace
    from ratelens.plans.catalog import star as table_star
    for s in (star, table_star(spark, SF_SMALL)):
        summed = replace(s, ratings=s.ratings.limit(0), partials=R.report_partials(s))
        assert sorted(rows(report(summed)), key=str) == sorted(rows(report(s)), key=str)


def test_one_pass_over_the_ratings_serves_all_reports(spark):
    from ratelens.plans.catalog import star as table_star
    s = table_star(spark, SF_SMALL)
    plan = R.report_partials(s)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("l_partkey") and plan.count("Expand") == 1
    # two scans: rows with a user key and rows without one go separate ways
    import re
    assert len(re.findall(r"FileScan parquet \[[^\]]*l_partkey", plan)) <= 2


def test_a_heavy_user_is_spread_at_the_default_thresholds(spark):
    from pyspark.sql import functions as F
    from ratelens.operators.lookup import heavy_keys, spread_lookup
    n = 30_000
    fact = spark.range(n).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("user_key"),
                                 (F.col("id") % 50).alias("movie_id"), (F.col("id") % 5).cast("double").alias("rating"), F.col("id").alias("ts"))
    users = spark.range(n).select(F.col("id").alias("user_key"), F.lit("M").alias("gender"))
    heavy = heavy_keys(fact, "user_key", least=1000)
    assert heavy == (7,)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these partitions are small
    try:
        joined = spread_lookup(fact.hint("merge"), users, "user_key", heavy)
        sizes = [r["n"] for r in joined.where("user_key = 7").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == n // 3 + 1 and max(sizes) < n // 6
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, fact.join(users, "user_key", "left").collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_reports_with_heavy_users_are_the_same(spark, star):
    from dataclasses import replace
    hot = replace(star, heavy_users=(1, 4, 99))
    for report in USER_REPORTS:
        assert sorted(rows(report(hot)), key=str) == sorted(rows(report(star)), key=str)
