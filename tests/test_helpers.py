"""Smaller helpers: writers, explode, command line."""

from pyspark.sql import functions as F

from conftest import rows
from ratelens import sinks
from ratelens.operators.explode import explode_values


def test_write_many_shares_one_parent(spark, tmp_path):
    parent = spark.range(100).withColumn("g", F.col("id") % 3)
    outs = {str(tmp_path / "a"): parent.groupBy("g").count(), str(tmp_path / "b"): parent.where("id < 10")}
    sinks.write_many(outs, parent=parent)
    assert not parent.is_cached
    assert spark.read.text(str(tmp_path / "a")).count() == 3
    assert spark.read.text(str(tmp_path / "b")).count() == 10


def test_explode_values_keep_and_separator(spark):
    df = spark.createDataFrame([(1, "a, b,,c", "x")], "id int, tags string, other string")
    got = rows(explode_values(df, "tags", r",\s*", out="tag", keep=["id"]))
    assert got == [(1, "a"), (1, "b"), (1, "c")]


def test_command_line_rejects_unknown_policy():
    import pytest
    from ratelens.__main__ import parse_args
    with pytest.raises(SystemExit):
        parse_args(["ratings", "--ratings", "r", "--movies", "m", "--users", "u", "--occupations", "o",
                    "--out", "x", "--on-bad", "skip"])
