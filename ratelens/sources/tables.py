"""The entities read from the driver's parquet tables.

Role mapping (every entity is derived by Spark from whole tables):

* ratings     ``lineitem``: movie = l_partkey, rating = l_quantity,
              ts = epoch seconds of l_shipdate, user key = l_orderkey; the
              user key of every tenth order is blank (unknown user).
* users       keyed by the ratings' user key: ``orders`` (o_orderkey ->
              o_custkey) enriched from ``customer``: gender 'M' for the
              BUILDING segment else 'F', age from the account balance,
              occupation = c_nationkey, or 100 more (an unknown occupation)
              for every seventh customer.
* movies      ``part``: id p_partkey, title p_name, genres "p_type|<words of
              p_name>"; every eleventh part has another id (its ratings are
              of an unknown movie).
* occupations ``nation``: n_nationkey, n_name.
* reviews     ``documents`` left-joined with ``labels``: id doc_id, review
              text (line breaks as spaces, as in a line file), aspect source,
              category lang, sentiment from quality (1 positive, 0 negative,
              unlabelled neutral).

* line files   the same entities as the comma files hold them, whole tables as
              lines (``rating_lines``, ``movie_lines``, ``user_lines``, ``occupation_lines``):
              some rows, chosen by their keys, become headers, blank, short or
              unparsable lines.

Keying users by the order key lets a report join lineitem once; the small
orders->customer lookup is resolved first (orders is 1/4 of lineitem).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.functions.time import epoch_seconds

REVIEW_HEADER = "id;review;aspect;category;sentiment"


# Read schemas of the driver tables: only the columns the entities use.
# Declaring them skips the schema-inference job of every parquet read and
# fixes the types the reports rely on.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_type string",
    "nation": "n_nationkey int, n_name string",
    "documents": "doc_id bigint, text string, lang string, source string",
    "labels": "doc_id bigint, quality int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.when(F.col("l_orderkey") % 10 != 0, F.col("l_orderkey")).alias("user_key"),
        F.col("l_partkey").alias("movie_id"),
        F.col("l_quantity").alias("rating"),
        epoch_seconds("l_shipdate").alias("ts"),
    )


def rating_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Ratings as two like inputs (line status 'O' and all others), as two rating files."""
    li = table(spark, sf_dir, "lineitem")

    first = F.col("l_linestatus").eqNullSafe("O")

    def part(cond):
        return li.where(cond).select(
            F.col("l_orderkey").alias("user_key"), F.col("l_partkey").alias("movie_id"),
            F.col("l_quantity").alias("rating"), epoch_seconds("l_shipdate").alias("ts"))
    return part(first), part(~first)


def customer_age():
    """Age in years derived from the account balance: 16 + floor((bal+1000)/200)."""
    return (F.lit(16) + F.floor((F.col("c_acctbal") + 1000) / 200)).cast("int")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("user_key"), F.col("o_custkey").alias("user_id"))
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "M").otherwise("F").alias("gender"),
        customer_age().alias("age"),
        (F.col("c_nationkey") + F.when(F.col("c_custkey") % 7 == 0, 100).otherwise(0)).alias("occupation_id"),
    )
    return orders.join(cust, "user_id", "left")


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.select(
        F.when(F.col("p_partkey") % 11 == 0, -F.col("p_partkey")).otherwise(F.col("p_partkey")).alias("movie_id"),
        F.col("p_name").alias("title"),
        F.concat_ws("|", F.col("p_type"), F.regexp_replace("p_name", " ", "|")).alias("genres"),
    )


def occupations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("occupation_id"), F.col("n_name").alias("occupation"))


def one_line(c: str):
    """The text with every line break (CR LF, CR or LF) as one space."""
    out = F.col(c)
    for brk in ("\r\n", "\r", "\n"):
        out = F.replace(out, F.lit(brk), F.lit(" "))
    return out


def review_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews without the sentiment (no join with the labels)."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), one_line("text").alias("review"),
        F.col("source").alias("aspect"), F.col("lang").alias("category"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")


def labelled(texts: DataFrame, quality: DataFrame) -> DataFrame:
    """Texts with the sentiment that their quality label gives."""
    sentiment = (F.when(F.col("quality") == 1, "positive")
                 .when(F.col("quality") == 0, "negative").otherwise("neutral"))
    return texts.join(quality, "id", "left").select("id", "review", "aspect", "category", sentiment.alias("sentiment"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(review_texts(spark, sf_dir), labels(spark, sf_dir))


def review_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ``id;review;aspect;category;sentiment`` lines (one column ``line``)
    with a header line, as a line-oriented review file holds them."""
    r = reviews(spark, sf_dir)
    line = F.concat_ws(";", F.col("id").cast("string"), "review", "aspect", "category", "sentiment")
    header = spark.range(1).select(F.lit(REVIEW_HEADER).alias("line"))
    return header.unionByName(r.select(line.alias("line")))


def _line(key, shapes: dict, plain):
    """``plain``, or for some values of ``key`` another shape of the line."""
    out = None
    for k, shape in shapes.items():
        out = F.when(key == k, shape) if out is None else out.when(key == k, shape)
    return out.otherwise(plain).alias("value")


def _comma(*parts, sep: str = ","):
    return F.concat_ws(sep, *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts])


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as lines of a rating file; nine in twenty are irregular."""
    li = table(spark, sf_dir, "lineitem").withColumn("ts", epoch_seconds("l_shipdate"))
    o, p, q, t = "l_orderkey", "l_partkey", "l_quantity", "ts"
    x = F.lit
    return li.select(_line((F.col(o) * 7 + F.col("l_linenumber")) % 20, {
        0: F.when(F.col(o) % 2 == 0, "").otherwise(" \t"),       # blank
        1: x("UserID,MovieID,Rating,Timestamp"),                  # header
        2: _comma(o, p),                                          # short
        3: _comma(o, p, x("x"), t),                               # rating is no number
        4: _comma(F.concat(F.col(o).cast("string"), x(".5")), p, q, t),   # user is no whole number
        5: _comma(o, x(" "), q, t),                               # movie is missing
        6: _comma(o, p, q, t, x("more")),                         # long
        7: F.concat(x(" "), _comma(o, p, q, t, sep=" ,\t"), x(" ")),      # blanks round the fields
        8: _comma(o, p, q),                                       # time is missing
    }, _comma(o, p, q, t)))


def movie_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as lines of a movie file; seven in thirteen are irregular."""
    m = table(spark, sf_dir, "part").withColumn("g", F.concat_ws("|", "p_type", F.replace(F.col("p_name"), F.lit(" "), F.lit("|"))))
    i, n, g, x = "p_partkey", "p_name", "g", F.lit
    return m.select(_line(F.col(i) % 13, {
        0: x("  "), 1: _comma(i, n), 2: F.concat(x("x"), _comma(i, n, g)), 3: _comma(i, n, x(" The"), g),
        4: F.concat(x(" "), _comma(i, n, g, sep=" , ")), 5: F.col(i).cast("string"), 6: _comma(F.concat(F.col(i).cast("string"), x(".0")), n, g),
    }, _comma(i, n, g)))


def user_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as lines of a user file; seven in eleven are irregular. ``_order``
    is the place of the line: one file of all, then one of corrections."""
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", "M").otherwise("F").alias("g"), customer_age().alias("a"), "c_nationkey")
    i, g, a, o, x = "c_custkey", "g", "a", "c_nationkey", F.lit
    first = c.select(_line(F.col(i) % 11, {
        0: _comma(i, x(""), a, o), 1: _comma(i, g, x(" "), o), 2: _comma(i, g, a), 3: _comma(x("x"), g, a, o), 4: x(""),
        5: _comma(i, g, x("old"), o), 6: _comma(i, g, a, o, sep=" , "),
    }, _comma(i, g, a, o)), F.struct(F.lit(0).alias("file"), F.lit(0).alias("part"), F.col(i).alias("line")).alias("_order"))
    again = c.where(F.col(i) % 3 == 0)
    later = again.select(_comma(i, x("X"), F.col(a) + 1, o).alias("value"),
                         F.struct(F.lit(1).alias("file"), F.lit(0).alias("part"), F.col(i).alias("line")).alias("_order"))
    last = again.where(F.col(i) % 2 == 0).select(
        _comma(i, x(""), x(""), x("99")).alias("value"),
        F.struct(F.lit(1).alias("file"), F.lit(1).alias("part"), F.col(i).alias("line")).alias("_order"))
    return first.unionByName(later).unionByName(last)


def occupation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation`` as lines of an occupation file: names with commas, short and blank lines."""
    i, n, x = "n_nationkey", "n_name", F.lit
    return table(spark, sf_dir, "nation").select(_line(F.col(i) % 5, {
        0: _comma(i, n, x(" and others")), 1: F.col(i).cast("string"), 2: F.concat(x(" "), _comma(i, n, sep=" ,")), 3: x(" "),
    }, _comma(i, n)))


def text_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews with their line breaks, as strings; every ninth without an aspect, every seventh with an empty category."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("review"),
        F.when(F.col("doc_id") % 9 != 0, F.col("source")).alias("aspect"),
        F.when(F.col("doc_id") % 7 == 0, "").otherwise(F.col("lang")).alias("category"),
        F.concat(F.lit("a\\tb\t"), F.col("doc_id").cast("string")).alias("sentiment"))
