"""Multi-valued attributes to one row per value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_values(df: DataFrame, column: str, sep_regex: str = r"\|", out: str | None = None,
                   keep=None) -> DataFrame:
    """One row per non-empty value of a delimited string column.

    Empty parts ("Drama||Crime", a trailing "|") are dropped; a NULL or
    empty column yields no row."""
    out = out or column
    keep = [c for c in (keep or df.columns) if c != column]
    parts = F.filter(F.split(F.col(column), sep_regex), lambda v: v != "")
    return df.select(*keep, F.explode(parts).alias(out))
