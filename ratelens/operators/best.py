"""Arg-max with minimum support (the best item among those with >= k ratings)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def qualifying(min_n: int, measure: str = "avg_rating", n: str = "n", strictly_positive: bool = True) -> Column:
    enough = F.col(n) >= min_n
    return enough & (F.col(measure) > 0) if strictly_positive else enough


def best_with_support(stats: DataFrame, min_n: int, measure: str = "avg_rating",
                      id_col: str = "movie_id", n: str = "n", carry=("title",),
                      strictly_positive: bool = True) -> DataFrame:
    """Exactly one row: the item with the highest ``measure`` among items
    with ``n >= min_n``; ties go to the lowest ``id_col``. When nothing
    qualifies every column is NULL and ``found`` is false.

    A global ``max_by`` aggregate: each task keeps one candidate, so only
    one row per partition reaches the final aggregate.
    """
    qualifies = qualifying(min_n, measure, n, strictly_positive)
    rank = F.struct(F.col(measure), -F.col(id_col))
    cols = [id_col, *carry, measure, n]
    winner = F.max_by(F.struct(*[F.col(c) for c in cols]), rank)
    best = (stats.where(qualifies)
            .agg(winner.alias("_best"))
            .select(*[F.col("_best")[c].alias(c) for c in cols]))
    return best.withColumn("found", F.col(id_col).isNotNull())
