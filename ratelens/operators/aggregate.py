"""Mean-and-count aggregates.

Every aggregate is a ``groupBy().agg()`` of sums and counts, so Spark runs
a partial aggregate before the shuffle and a hot key collapses map-side.
Means are carried as (sum, count) and divided at the end, which makes them
composable: partial results by a finer key can be combined by a coarser one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.numeric import round2

SUM, CNT = "_sum", "_cnt"


def _cols(keys) -> list:
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def sum_count(df: DataFrame, keys, value: str = "rating") -> DataFrame:
    """Per key: sum of ``value`` and number of non-null values."""
    return df.groupBy(*_cols(keys)).agg(F.sum(value).alias(SUM), F.count(value).alias(CNT))


def combine(partials: DataFrame, keys) -> DataFrame:
    """Merge (sum, count) partials onto a coarser key."""
    return partials.groupBy(*_cols(keys)).agg(F.sum(SUM).alias(SUM), F.sum(CNT).alias(CNT))


def finish(partials: DataFrame, avg: str = "avg_rating", n: str | None = "n",
           rounded: bool = True) -> DataFrame:
    """Turn (sum, count) into mean and count columns."""
    mean = F.col(SUM) / F.col(CNT)
    out = partials.withColumn(avg, round2(mean) if rounded else mean)
    if n:
        out = out.withColumn(n, F.col(CNT).cast("long"))
    return out.drop(SUM, CNT)


def mean_count(df: DataFrame, keys, value: str = "rating", avg: str = "avg_rating",
               n: str | None = "n", rounded: bool = True) -> DataFrame:
    return finish(sum_count(df, keys, value), avg, n, rounded)


def conditional_means(df: DataFrame, keys, value: str, cases: dict[str, Column],
                      empty=None, rounded: bool = True) -> DataFrame:
    """One mean column per named predicate, in a single aggregate
    (one shuffle, unlike ``pivot``). ``empty`` fills a group with no rows."""
    aggs = []
    for name, pred in cases.items():
        s, c = F.sum(F.when(pred, F.col(value))), F.count(F.when(pred, F.col(value)))
        mean = s / F.nullif(c, F.lit(0))
        mean = round2(mean) if rounded else mean
        if empty is not None:
            mean = F.coalesce(mean, F.lit(empty))
        aggs.append(mean.alias(name))
    return df.groupBy(*_cols(keys)).agg(*aggs)


def conditional_combine(partials: DataFrame, keys, cases: dict[str, Column], empty=None, rounded: bool = True) -> DataFrame:
    """``conditional_means`` from (sum, count) partials of a finer key."""
    aggs = []
    for name, pred in cases.items():
        mean = F.sum(F.when(pred, F.col(SUM))) / F.nullif(F.sum(F.when(pred, F.col(CNT))), F.lit(0))
        mean = round2(mean) if rounded else mean
        aggs.append((mean if empty is None else F.coalesce(mean, F.lit(empty))).alias(name))
    return partials.groupBy(*_cols(keys)).agg(*aggs)


def mean_by_dimension(fact: DataFrame, dim: DataFrame, key: str, attrs, value: str = "rating",
                      how: str = "left", defaults: dict | None = None, avg: str = "avg_rating",
                      n: str | None = "n", rounded: bool = True) -> DataFrame:
    """Mean/count of ``value`` grouped by dimension attributes.

    The fact is first reduced to one (sum, count) row per join key, so the
    join shuffles at most one row per key instead of every fact row, and a
    hot key cannot skew the join. Valid because all fact rows of one key
    share the same attributes.
    """
    from ratelens.operators.lookup import lookup

    partial = sum_count(fact, key, value)
    joined = lookup(partial, dim, key, how=how, defaults=defaults)
    return finish(combine(joined, attrs), avg, n, rounded)
