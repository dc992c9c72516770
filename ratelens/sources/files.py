"""Readers for line-oriented text inputs (comma files, ';' review files,
tab-separated files) with explicit schemas and a bad-record policy.

Lines are read with ``spark.read.text`` (splittable, one row per line) and
split with built-in expressions, so trimming, header rules and the
``on_bad`` policy behave the same whichever columns a query later prunes.

on_bad:
  ``drop``  rows with a missing or unparsable required field are removed;
  ``null``  rows are kept, bad fields become NULL;
  ``fail``  the job raises on the first bad field of any row it reads,
            whichever columns are used later and whatever the ANSI setting
            (one filter looks at all fields of the line).

Ids of the comma files are whole numbers: ``10.5`` is a bad id. ``NaN`` is a
number: such a rating is kept, and its means are NaN.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens import schemas
from ratelens.functions.text import extract_or_null, full_match, java_trim, loose_long, unescape_field
from ratelens.operators.lookup import last_per_key

ON_BAD = ("drop", "null", "fail")

# Header rules of the reference inputs.
RATINGS_HEADER_PREFIX = "UserID"
REVIEWS_HEADER_REGEX = "id;.*"
# Right-anchored review line: the review (group 2) may itself contain ';'.
REVIEW_LINE_REGEX = r"^([^;]+);(.+);([^;]+);([^;]+);([^;]+)$"


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_lines(spark: SparkSession, paths, with_order: bool = False) -> DataFrame:
    """One row per line (column ``value``); optionally ``_order``, which grows
    along the paths in the order given, along the files of one path by name,
    and along the lines of a file."""
    if not with_order:
        return spark.read.text(_paths(paths))

    def placed(i: int, path: str) -> DataFrame:
        place = F.struct(F.lit(i).alias("given"), "_metadata.file_path", "_metadata.file_block_start",
                         F.monotonically_increasing_id().alias("line"))
        return spark.read.text(path).select("value", place.alias("_order"))
    return reduce(DataFrame.unionByName, [placed(i, p) for i, p in enumerate(_paths(paths))])


def _check(on_bad: str):
    if on_bad not in ON_BAD:
        raise ValueError(f"on_bad must be one of {ON_BAD}, got {on_bad!r}")


def _typed(raw: Column, dtype: T.DataType) -> Column:
    return raw if isinstance(dtype, T.StringType) else raw.try_cast(dtype)


def _apply_policy(lines: DataFrame, value: str, fields: dict[str, Column], bad: Column,
                  on_bad: str, required: Sequence[str]) -> DataFrame:
    """The typed ``fields`` of each line under the bad-record policy (and the
    line's ``_order``, when it has one)."""
    if on_bad == "fail":
        message = F.concat(F.lit("bad input line: "), F.col(value))
        lines = lines.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    order = [c for c in lines.columns if c == "_order"]
    out = lines.select(*[c.alias(name) for name, c in fields.items()], *order)
    if on_bad == "drop":
        for name in required:
            out = out.where(F.col(name).isNotNull())
    return out


def parse_fields(lines: DataFrame, schema: T.StructType, sep: str = ",", on_bad: str = "drop",
                 limit: int = -1, required: Sequence[str] | None = None, trim: bool = True,
                 empty_as_null: bool = False, header_prefix: str | None = None,
                 header_regex: str | None = None, skip_blank: bool = True,
                 value: str = "value", escaped: bool = False) -> DataFrame:
    """Split each line on the regex ``sep`` (at most ``limit`` parts) and
    type the fields by position against ``schema``. ``escaped`` fields are
    those of ``functions.text.escape_field``."""
    _check(on_bad)
    v = F.col(value)
    if skip_blank:
        lines = lines.where(F.length(java_trim(v)) > 0)
    if header_prefix:
        lines = lines.where(~v.startswith(header_prefix))
    if header_regex:
        lines = lines.where(~full_match(v, header_regex))
    parts = F.split(v, sep, limit)
    fields, bad = {}, F.lit(False)
    for i, field in enumerate(schema.fields):
        raw = F.get(parts, i)
        if trim:
            raw = java_trim(raw)
        if escaped:
            raw = unescape_field(raw)
        typed = _typed(F.nullif(raw, F.lit("")) if empty_as_null else raw, field.dataType)
        blank = raw == "" if empty_as_null else raw.isNull() & (F.size(parts) > i) if escaped else F.lit(False)
        bad = bad | F.get(parts, i).isNull() | (typed.isNull() & ~F.coalesce(blank, F.lit(False)))
        fields[field.name] = typed
    return _apply_policy(lines, value, fields, bad, on_bad, required or schema.fieldNames())


def read_delimited(spark: SparkSession, paths, schema: T.StructType, **kw) -> DataFrame:
    """Several like files in one scan (a list of paths is one read)."""
    return parse_fields(read_lines(spark, paths), schema, **kw)


def read_ratings(spark: SparkSession, paths, on_bad: str = "drop") -> DataFrame:
    """``UserID,MovieID,Rating,Timestamp``; optional ``UserID...`` header,
    optional spaces around fields. ``user_key`` mirrors ``user_id``."""
    return parse_rating_lines(read_lines(spark, paths), on_bad)


def parse_rating_lines(lines: DataFrame, on_bad: str = "drop") -> DataFrame:
    """The lines of ``read_ratings`` (column ``value``)."""
    df = parse_fields(lines, schemas.RATINGS, on_bad=on_bad, required=["movie_id", "rating"], header_prefix=RATINGS_HEADER_PREFIX)
    return df.withColumn("user_key", F.col("user_id"))


def parse_movie_lines(lines: DataFrame, on_bad: str = "drop", value: str = "value") -> DataFrame:
    """``MovieID,Title,G1|G2``: the first field is the id, the last the
    genres and everything between is the title, so titles keep commas.
    A two-field line has a title and no genres."""
    _check(on_bad)
    v = F.col(value)
    three = r"^([^,]*),(.*),([^,]*)$"
    two = r"^([^,]*),([^,]*)$"
    raw_id = F.coalesce(extract_or_null(v, three, 1), extract_or_null(v, two, 1))
    title = F.coalesce(extract_or_null(v, three, 2), extract_or_null(v, two, 2))
    fields = {"movie_id": _typed(java_trim(raw_id), T.LongType()), "title": java_trim(title),
              "genres": java_trim(extract_or_null(v, three, 3))}
    bad = fields["movie_id"].isNull() | fields["title"].isNull()
    lines = lines.where(F.length(java_trim(v)) > 0)
    return _apply_policy(lines, value, fields, bad, on_bad, ["movie_id", "title"])


def _dimension(rows: DataFrame, key: str, last: bool) -> DataFrame:
    return last_per_key(rows, key, "_order") if last else rows


def read_movies(spark: SparkSession, paths, on_bad: str = "drop", last: bool = False) -> DataFrame:
    """``last`` keeps the last line of a repeated id, as a dictionary does."""
    return _dimension(parse_movie_lines(read_lines(spark, paths, with_order=last), on_bad), "movie_id", last)


def read_users(spark: SparkSession, paths, on_bad: str = "drop", last: bool = False) -> DataFrame:
    """``UserID,Gender,Age,OccupationID``; a missing or bad cell other than
    the id becomes NULL. ``user_key`` mirrors ``user_id``; ``last`` keeps the
    last line of a repeated id."""
    return parse_user_lines(read_lines(spark, paths, with_order=last), on_bad, last)


def parse_user_lines(lines: DataFrame, on_bad: str = "drop", last: bool = False) -> DataFrame:
    """The lines of ``read_users`` (column ``value``; with ``last`` also ``_order``)."""
    df = parse_fields(lines, schemas.USERS, on_bad=on_bad, required=["user_id"], empty_as_null=True)
    return _dimension(df, "user_id", last).withColumn("user_key", F.col("user_id"))


def read_occupations(spark: SparkSession, paths, on_bad: str = "drop", last: bool = False) -> DataFrame:
    return parse_occupation_lines(read_lines(spark, paths, with_order=last), on_bad, last)


def parse_occupation_lines(lines: DataFrame, on_bad: str = "drop", last: bool = False) -> DataFrame:
    """``ID,Name``: everything behind the first comma is the name."""
    return _dimension(parse_fields(lines, schemas.OCCUPATIONS, on_bad=on_bad, limit=2), "occupation_id", last)


def parse_review_lines(lines: DataFrame, value: str = "line") -> DataFrame:
    """``id;review;aspect;category;sentiment`` lines to columns.

    The header (a line fully matching ``id;.*``) is removed; a line that
    does not match ``REVIEW_LINE_REGEX`` is kept with all five columns NULL;
    an id that is not a number is NULL.

    The regex runs once per line, as a guard. When it matches, its groups
    are exactly the ';'-separated fields: the first field is the id, the
    last three are aspect, category and sentiment (``[^;]+`` cannot hold a
    ';'), and the review is everything in between (it may hold ';'). So the
    fields are cut with ``split`` instead of five more regex evaluations.
    """
    v = F.col(value)
    body = lines.where(~full_match(v, REVIEWS_HEADER_REGEX))
    ok = v.rlike(REVIEW_LINE_REGEX)
    parts = F.split(v, ";")
    n = F.size(parts)

    def field(i):
        return F.when(ok, F.get(parts, i))
    return body.select(
        loose_long(field(0)).alias("id"),
        F.when(ok, F.array_join(F.slice(parts, F.lit(2), n - 4), ";")).alias("review"),
        field(n - 3).alias("aspect"),
        field(n - 2).alias("category"),
        field(n - 1).alias("sentiment"),
    )


def read_reviews_raw(spark: SparkSession, paths) -> DataFrame:
    return parse_review_lines(read_lines(spark, paths).withColumnRenamed("value", "line"))


def read_reviews_tsv(spark: SparkSession, paths, schema: T.StructType = schemas.REVIEWS_TEXT,
                     escaped: bool = False) -> DataFrame:
    """Tab-separated reviews, no header; an empty field is NULL, missing
    trailing fields are NULL, values are not trimmed. ``escaped`` reads what
    ``sinks.write_tsv(escaped=True)`` wrote, with every value as it was."""
    return read_delimited(spark, paths, schema, sep="\t", on_bad="null", trim=False,
                          empty_as_null=not escaped, skip_blank=False, escaped=escaped)


def read_stopword_pattern(spark: SparkSession, path: str) -> str:
    """The first line of a one-line pattern file, as a scalar parameter
    (a single bounded line, read once)."""
    rows = spark.read.text(path).limit(1).collect()
    if not rows:
        raise ValueError(f"no pattern in {path}")
    return rows[0][0]


def read_routed(spark: SparkSession, paths, routes: dict[str, Callable[[DataFrame], DataFrame]]
                ) -> dict[str, DataFrame]:
    """Mixed files read as lines; a file goes to the parser of the first route
    whose key is contained in its name (e.g. 'users', 'ratings').

    Files are chosen when they are listed, so each route's scan holds its own
    files only. A name with the keys of several routes is listed by each of
    them and dropped by all but the first."""
    out, earlier = {}, []
    for key, parse in routes.items():
        glob = "*" + re.sub(r"([\\*?\[\]{}])", r"\\\1", key) + "*"
        lines = spark.read.option("pathGlobFilter", glob).text(_paths(paths))
        for taken in earlier:
            lines = lines.where(~F.col("_metadata.file_name").contains(taken))
        out[key] = parse(lines.select("value"))
        earlier.append(key)
    return out


def route_parsers(on_bad: str = "drop") -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Parsers for the four rating-star file kinds, for ``read_routed``."""
    def ratings(lines):
        return parse_fields(lines, schemas.RATINGS, sep=r",\s*", on_bad=on_bad,
                            required=["movie_id", "rating"], header_prefix=RATINGS_HEADER_PREFIX
                            ).withColumn("user_key", F.col("user_id"))

    def users(lines):
        return parse_fields(lines, schemas.USERS, sep=r",\s*", on_bad=on_bad, required=["user_id"],
                            empty_as_null=True).withColumn("user_key", F.col("user_id"))

    def occupations(lines):
        return parse_occupation_lines(lines, on_bad)

    def movies(lines):
        return parse_movie_lines(lines, on_bad)
    return {"users": users, "ratings": ratings, "movies": movies, "occupation": occupations}
