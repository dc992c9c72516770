"""The stored layout: same reports, no exchange below the joins that move a fact."""

import re

import pytest

from conftest import SF_SMALL, rows
from ratelens.plans import ratings as R
from ratelens.plans import reviews as V
from ratelens.plans.catalog import star as table_star
from ratelens.sources import files, stored, tables
from test_skew import conf

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def below_join(df, key):
    """Operators under the first sort-merge join on ``key``."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(i for i, line in enumerate(lines) if f"SortMergeJoin [{key}" in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    out = []
    for line in lines[at + 1:]:
        body = line.lstrip(" :+-")
        if len(line) - len(body) <= depth:
            break
        out.append(body)
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored"))
    stored.store_star(table_star(spark, SF_SMALL), path, 4)
    stored.store_reviews(tables.review_texts(spark, SF_SMALL), tables.labels(spark, SF_SMALL), path, 4)
    return path


@pytest.mark.parametrize("report", [R.gender_long, R.gender_wide, lambda s: R.age_long(s, "five"), R.occupation_mean, R.movie_mean_count, R.year_mean])
def test_same_reports(spark, folder, report):
    assert rows(report(stored.stored_star(spark, folder))) == rows(report(table_star(spark, SF_SMALL)))


@pytest.mark.parametrize("report", [R.gender_long, lambda s: R.age_long(s, "five")])
def test_user_join_needs_no_exchange(spark, folder, report):
    with conf(spark, **NO_BROADCAST):
        under = below_join(report(stored.stored_star(spark, folder)), "user_key")
    assert any("Bucketed: true" in x or "SelectedBucketsCount" in x for x in under)
    assert under and not any(x.startswith("Exchange") for x in under), under


def test_label_join_needs_no_exchange(spark, folder):
    lines = stored.stored_review_lines(spark, folder)
    with conf(spark, **NO_BROADCAST):
        under = below_join(V.clean_sorted_reviews(files.parse_review_lines(lines)), "id")
    assert under and not any(x.startswith("Exchange") for x in under), under
    got = rows(V.clean_reviews(stored.stored_reviews(spark, folder)))
    assert sorted(got, key=str) == sorted(rows(V.clean_reviews(tables.reviews(spark, SF_SMALL))), key=str)


def test_tables_of_an_earlier_session_are_registered_again(spark, folder):
    before = rows(R.gender_long(stored.stored_star(spark, folder)))
    for t in spark.catalog.listTables():
        if re.match("stored_.*_(ratings|users)$", t.name):
            spark.sql(f"drop table {t.name}")
    assert rows(R.gender_long(stored.stored_star(spark, folder))) == before
    with conf(spark, **NO_BROADCAST):
        assert not any(x.startswith("Exchange") for x in below_join(R.gender_long(stored.stored_star(spark, folder)), "user_key"))


def test_fixture_star_with_unknown_users(spark, star, tmp_path):
    stored.store_star(star, str(tmp_path / "s"), 2)
    for report in (R.gender_long, R.gender_wide, lambda s: R.age_wide_text(s, "four"), R.occupation_mean):
        assert rows(report(stored.stored_star(spark, str(tmp_path / "s")))) == rows(report(star))
