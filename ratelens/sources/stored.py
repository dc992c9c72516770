"""A stored layout for repeated reports: fact and dimension bucketed alike.

``store_star`` and ``store_reviews`` write the tables whose join moves a fact,
bucketed on the join key with one number of buckets, as external Parquet tables
in a folder that all machines share. ``stored_star`` and ``stored_reviews``
read them back (registering them in the session's catalog where they are not
known yet), so that the joins of ratings with users and of texts with labels need no
exchange of either side. Reports are the same functions as for files.

Ratings without a user key are stored apart, unbucketed: one bucket would hold
them all. A heavy user's ratings fill one bucket; where that is too large,
read the ratings as files and spread them (``plans.ratings.with_heavy_users``).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.plans.ratings import RatingsStar

LAYOUT = "layout"  # one small text file per stored table: schema, key and number of buckets


def write_bucketed(df: DataFrame, folder: str, name: str, key: str, buckets: int) -> None:
    """``df`` as ``folder/name``, one file per bucket of ``key``."""
    spark, path = df.sparkSession, f"{folder.rstrip('/')}/{name}"
    table = _table(folder, name)
    spark.sql(f"drop table if exists {table}")
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key)
     .option("path", path).saveAsTable(table))
    note = json.dumps({"schema": df.schema.json(), "key": key, "buckets": buckets})
    spark.createDataFrame([(note,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}.{LAYOUT}")


def _table(folder: str, name: str) -> str:
    """A catalog name that differs for every folder."""
    return "stored_" + "".join(c if c.isalnum() else "_" for c in folder.strip("/").lower()) + f"_{name}"


def read_bucketed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table that ``write_bucketed`` wrote, in this session or an earlier one."""
    path, table = f"{folder.rstrip('/')}/{name}", _table(folder, name)
    if not spark.catalog.tableExists(table):
        note = json.loads(spark.read.text(f"{path}.{LAYOUT}").first()[0])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(json.loads(note["schema"])).fields)
        spark.sql(f"create table {table} ({columns}) using parquet options (path '{path}') "
                  f"clustered by (`{note['key']}`) into {int(note['buckets'])} buckets")
    return spark.table(table)


def store_star(star: RatingsStar, folder: str, buckets: int = 200) -> None:
    """Ratings and users bucketed by user key; movies and occupations as they are."""
    folder = folder.rstrip("/")
    write_bucketed(star.ratings.where("user_key is not null"), folder, "ratings", "user_key", buckets)
    star.ratings.where("user_key is null").write.mode("overwrite").parquet(f"{folder}/ratings_unknown")
    write_bucketed(star.users, folder, "users", "user_key", buckets)
    star.movies.write.mode("overwrite").parquet(f"{folder}/movies")
    if star.occupations is not None:
        star.occupations.write.mode("overwrite").parquet(f"{folder}/occupations")


def stored_star(spark: SparkSession, folder: str, occupations: bool = True) -> RatingsStar:
    folder = folder.rstrip("/")
    known = read_bucketed(spark, folder, "ratings")
    unknown = spark.read.schema(known.schema).parquet(f"{folder}/ratings_unknown")
    return RatingsStar(ratings=known.unionByName(unknown), movies=spark.read.parquet(f"{folder}/movies"),
                       users=read_bucketed(spark, folder, "users"), split=(known, unknown),
                       occupations=spark.read.parquet(f"{folder}/occupations") if occupations else None)


def store_reviews(texts: DataFrame, labels: DataFrame, folder: str, buckets: int = 200) -> None:
    """``texts`` (id, review, aspect, category) and ``labels`` (id, quality) bucketed by id."""
    write_bucketed(texts, folder, "texts", "id", buckets)
    write_bucketed(labels, folder, "labels", "id", buckets)


def stored_reviews(spark: SparkSession, folder: str) -> DataFrame:
    from ratelens.sources.tables import labelled
    return labelled(read_bucketed(spark, folder, "texts"), read_bucketed(spark, folder, "labels"))


def stored_review_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The stored reviews as raw review lines without a header."""
    r = stored_reviews(spark, folder)
    return r.select(F.concat_ws(";", F.col("id").cast("string"), "review", "aspect", "category", "sentiment").alias("line"))
