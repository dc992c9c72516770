"""Explicit schemas of the entities (never inferred)."""

from pyspark.sql import types as T

# Ratings fact: one row per (user, item) rating; ts is epoch seconds (UTC).
RATINGS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("movie_id", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("ts", T.LongType()),
])

# Items: genres is a multi-valued attribute ("Drama|Crime").
MOVIES = T.StructType([
    T.StructField("movie_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

USERS = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("occupation_id", T.LongType()),
])

OCCUPATIONS = T.StructType([
    T.StructField("occupation_id", T.LongType()),
    T.StructField("occupation", T.StringType()),
])

# Labelled reviews after parsing (id may be NULL when it does not parse).
REVIEWS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("review", T.StringType()),
    T.StructField("aspect", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("sentiment", T.StringType()),
])

# The same five columns as strings, as a tab-separated reload sees them.
REVIEWS_TEXT = T.StructType([T.StructField(f.name, T.StringType()) for f in REVIEWS.fields])
