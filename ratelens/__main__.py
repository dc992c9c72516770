"""Command line: run every rating or review report over text inputs.

  python -m ratelens ratings --ratings r1.txt r2.txt --movies movies.txt \\
      --users users.txt --occupations occupation.txt --out OUT [--on-bad drop|null|fail]
  python -m ratelens reviews --input hotel-review.csv [--stopwords stopwords_regex.txt] --out OUT

Run it with spark-submit on a cluster; the session and its settings
(shuffle partitions, spark.checkpoint.dir, ...) come from there.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def parse_args(argv):
    p = argparse.ArgumentParser(prog="ratelens")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("ratings", help="per movie/genre/gender/age/occupation/year reports")
    r.add_argument("--ratings", nargs="+", required=True)
    r.add_argument("--movies", required=True)
    r.add_argument("--users", required=True)
    r.add_argument("--occupations", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--on-bad", default="drop", choices=["drop", "null", "fail"])
    v = sub.add_parser("reviews", help="cleaned reviews, word/category/aspect reports")
    v.add_argument("--input", nargs="+", required=True)
    v.add_argument("--stopwords", help="one-line stop-word regex file (default: built-in list)")
    v.add_argument("--out", required=True)
    return p.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> dict[str, str]:
    from ratelens.functions.text import STOPWORD_PATTERN
    from ratelens.plans.jobs import run_rating_jobs, run_review_jobs
    from ratelens.plans.ratings import RatingsStar
    from ratelens.sources import files

    args = parse_args(sys.argv[1:] if argv is None else argv)
    spark = spark or SparkSession.builder.appName(f"ratelens-{args.command}").getOrCreate()
    if args.command == "ratings":
        star = RatingsStar(
            ratings=files.read_ratings(spark, args.ratings, on_bad=args.on_bad),
            movies=files.read_movies(spark, args.movies, on_bad=args.on_bad, last=True),
            users=files.read_users(spark, args.users, on_bad=args.on_bad, last=True),
            occupations=files.read_occupations(spark, args.occupations, on_bad=args.on_bad, last=True),
        )
        return run_rating_jobs(star, args.out)
    lines = files.read_lines(spark, args.input).withColumnRenamed("value", "line")
    pattern = files.read_stopword_pattern(spark, args.stopwords) if args.stopwords else STOPWORD_PATTERN
    return run_review_jobs(lines, args.out, pattern)


if __name__ == "__main__":
    for name, path in main().items():
        print(f"{name}\t{path}")
