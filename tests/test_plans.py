"""Physical-plan checks: the operators plan the way the design says."""

import pytest

from ratelens.plans.catalog import QUERIES
from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_any_plan(spark, name):
    text = formatted(QUERIES[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in text, f"{name} runs Python: {node}"


@pytest.mark.parametrize("name", ["top_words_category", "top_words_category_positive",
                                  "top_words_category_negative"])
def test_per_group_top_k_limits_before_shuffle(spark, name):
    text = formatted(QUERIES[name](spark, SF_SMALL))
    assert text.count("WindowGroupLimit") >= 2  # partial (map side) + final


@pytest.mark.parametrize("name", ["top_words_k", "top_aspect_positive", "top_aspect_negative"])
def test_global_top_k_is_take_ordered(spark, name):
    assert "TakeOrderedAndProject" in formatted(QUERIES[name](spark, SF_SMALL))


def test_column_pruning_reaches_scan(spark):
    text = formatted(QUERIES["movie_mean_count"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text


def test_filter_pushed_to_scan(spark):
    text = formatted(QUERIES["ratings_union_all"](spark, SF_SMALL))
    assert "PushedFilters: [EqualNullSafe(l_linestatus,O)]" in text
    assert "PushedFilters: [Not(EqualNullSafe(l_linestatus,O))]" in text


def test_small_dimension_is_broadcast(spark):
    text = formatted(QUERIES["occupation_mean"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in text and "n_nationkey" in text


def test_partial_aggregation_before_shuffle(spark):
    # every mean is a partial + final aggregate around one exchange
    text = formatted(QUERIES["year_mean"](spark, SF_SMALL))
    assert text.count("HashAggregate") >= 2


def test_occupation_aggregates_ratings_before_join(spark):
    df = QUERIES["occupation_mean"](spark, SF_SMALL)
    text = plan(df)
    join_at = min(i for i in (text.find("SortMergeJoin"), text.find("BroadcastHashJoin LeftOuter")) if i >= 0)
    # below the join (later in the tree string) lineitem is already aggregated per key
    below = text[join_at:]
    assert "HashAggregate(keys=[l_orderkey" in below or "HashAggregate(keys=[user_key" in below


def test_conditional_means_single_aggregate_exchange(spark):
    from pyspark.sql import functions as F
    from ratelens.operators.aggregate import conditional_means
    df = spark.createDataFrame([(1, "a", 1.0)], "k int, g string, rating double")
    assert plan(conditional_means(df, "k", "rating", {"a": F.col("g") == "a"})).count("Exchange") == 1


@pytest.mark.parametrize("name", ["category_count", "aspect_count", "top_aspect_positive", "top_aspect_negative"])
def test_label_counts_never_read_the_text(spark, name):
    text = formatted(QUERIES[name](spark, SF_SMALL))
    assert "ReadSchema" in text and "text" not in text.replace("Context", "")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_fixed_repartition(spark, name):
    assert "REPARTITION_BY" not in plan(QUERIES[name](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["top_words_category_positive", "top_words_category_by_sentiment"])
def test_sentiment_is_filtered_at_the_labels(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert "LeftOuter" not in text  # the filter on the sentiment made it an inner join
    labels = next(line for line in text.split("\n") if "quality" in line and "Filter" in line)
    assert "quality" in labels


@pytest.mark.parametrize("name", ["age_wide_4", "age_long_5", "age_long_text", "age_wide_sentence"])
def test_age_reports_never_broadcast_the_fact(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert "SortMergeJoin [user_key" in text
    for line in text.split("\n"):
        if "BroadcastHashJoin [user_key" in line:
            raise AssertionError(line)


def test_movie_report_reads_the_ratings_once(spark):
    assert plan(QUERIES["movie_report_with_result"](spark, SF_SMALL)).count("FileScan parquet [l_") == 1


def _join_subtree(plan_text: str, marker: str) -> list[str]:
    lines = plan_text.split("\n")
    at = next(i for i, line in enumerate(lines) if marker in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    out = []
    for line in lines[at + 1:]:
        body = line.lstrip(" :+-")
        if len(line) - len(body) <= depth:
            break
        out.append(body)
    return out


@pytest.mark.parametrize("name", ["movie_mean_count", "genre_mean_count"])
def test_ratings_aggregated_per_movie_before_the_join(spark, name):
    with_no_broadcast = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                         "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in with_no_broadcast}
    try:
        for k, v in with_no_broadcast.items():
            spark.conf.set(k, v)
        text = plan(QUERIES[name](spark, SF_SMALL))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    below = _join_subtree(text, "SortMergeJoin [movie_id")
    agg = [b for b in below if b.startswith("HashAggregate(keys=[l_partkey") or
           b.startswith("HashAggregate(keys=[movie_id")]
    scan = [i for i, b in enumerate(below) if "FileScan parquet [l_partkey" in b]
    assert agg and scan, below
    assert below.index(agg[0]) < scan[0]  # the aggregate sits between the join and the ratings scan


def _raw_fact_exchanges(plan_text: str, *scan_markers: str) -> int:
    """Exchanges that carry un-aggregated rows of the scanned fact: the path
    from the exchange down to the fact scan holds no HashAggregate."""
    lines = [ln for ln in plan_text.split("== Initial Plan ==")[0].split("\n") if ln.strip()]
    nodes = [(len(ln) - len(ln.lstrip(" :+-")), ln.lstrip(" :+-")) for ln in lines]
    count = 0
    for j, (dj, body) in enumerate(nodes):
        if not all(m in body for m in scan_markers):
            continue
        depth, path = dj, []
        for i in range(j - 1, -1, -1):  # ancestors of the scan, nearest first
            if nodes[i][0] < depth:
                path.append(nodes[i][1])
                depth = nodes[i][0]
        for node in path:
            if node.startswith("HashAggregate") or node.startswith("SortAggregate"):
                break
            if node.startswith("Exchange") and "SinglePartition" not in node:
                count += 1
    return count


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_fact_rows_cross_the_network_at_most_once(spark, name):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        text = plan(QUERIES[name](spark, SF_SMALL))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    ratings = _raw_fact_exchanges(text, "FileScan parquet [l_")
    texts = _raw_fact_exchanges(text, "FileScan parquet [doc_id", ",text#")
    assert ratings <= 1, (name, ratings)
    assert texts <= (2 if name == "reviews_clean" else 1), (name, texts)  # + the global sort
