"""Top-k globally and per group.

Global top-k plans as ``TakeOrderedAndProject`` (each task keeps k rows).
Per-group top-k uses ``row_number() <= k``, which Spark plans with a partial
``WindowGroupLimit`` before the shuffle, so a hot group ships at most k rows
per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(order: Sequence) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def top_k(df: DataFrame, k: int, order: Sequence) -> DataFrame:
    """First ``k`` rows by ``order``; include a unique key in ``order`` to break ties."""
    return df.orderBy(*_order(order)).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str] | str, order: Sequence, k: int,
                    rank_col: str | None = None) -> DataFrame:
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*_order(order))
    ranked = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
    return ranked.withColumnRenamed("_rank", rank_col) if rank_col else ranked.drop("_rank")
