"""Enrich a fact DataFrame from a dimension keyed by one column.

Join strategy: no hint is given. Spark broadcasts the dimension only when its
size estimate is under ``spark.sql.autoBroadcastJoinThreshold``, and AQE
re-checks with the exact runtime size; anything larger runs as a sort-merge
join, where AQE's skew handling splits a hot key's partition on the fact side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_per_key(dim: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the one with the largest ``order`` (a dictionary
    filled in that order keeps its last entry). NULL keys are left out."""
    rest = [c for c in dim.columns if c not in (key, order)]
    last = dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_last"))
    return last.select(key, *[F.col("_last")[c].alias(c) for c in rest])


def lookup(fact: DataFrame, dim: DataFrame, key: str, how: str = "left",
           defaults: dict | None = None) -> DataFrame:
    """``fact`` joined with ``dim`` on ``key`` (unique in ``dim``).

    how       ``left`` keeps fact rows without a match, ``inner`` drops them.
    defaults  ``{dim_column: Column | value}`` filled in for missing matches
              (the key itself, ``"Unknown"``, ...).
    """
    if how not in ("left", "inner"):
        raise ValueError(f"lookup supports left/inner, not {how!r}")
    out = fact.join(dim, on=key, how=how)
    for name, value in (defaults or {}).items():
        fill = value if isinstance(value, Column) else F.lit(value)
        out = out.withColumn(name, F.coalesce(F.col(name), fill))
    return out


SALTS = 64


def heavy_keys(fact: DataFrame, key: str, most: int = 1000, least: int = 10_000) -> tuple:
    """The keys that more than one row in ``most`` (and more than ``least`` rows)
    have: at most ``most`` values, so their list is bounded whatever the data."""
    counts = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    bar = max(least, fact.count() // most)
    return tuple(r[0] for r in counts.where(F.col("_n") > bar).select(key).collect())


def spread_lookup(fact: DataFrame, dim: DataFrame, key: str, heavy: tuple = (), how: str = "left",
                  salts: int = SALTS) -> DataFrame:
    """``lookup`` in which the fact rows of each heavy key are dealt to
    ``salts`` partitions; the dimension row of a heavy key stands once per salt.

    The salt is a hash of the fact row, so a recomputed task deals its rows as
    before. Rows equal in all columns share a salt."""
    if not heavy:
        return lookup(fact, dim, key, how=how)
    hot = F.col(key).isin(list(heavy))
    salt = F.when(hot, F.pmod(F.xxhash64(*[c for c in fact.columns]), F.lit(salts)).cast("int")).otherwise(0)
    copies = F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    joined = fact.withColumn("_salt", salt).join(dim.withColumn("_salt", copies), on=[key, "_salt"], how=how)
    return joined.drop("_salt")


def lookup_past_nulls(fact: DataFrame, dim: DataFrame, key: str, heavy: tuple = (), split: tuple | None = None) -> DataFrame:
    """Left ``lookup`` of a raw fact in which many rows may have a NULL key:
    those go round the join with NULL attributes, so they never meet in one
    partition of it. Rows of ``heavy`` keys are spread. ``split`` is the fact's
    rows with and without a key, where they are stored apart."""
    with_key, without = split or (fact.where(F.col(key).isNotNull()), fact.where(F.col(key).isNull()))
    extra = [c for c in dim.columns if c != key]
    types = dict(dim.dtypes)
    known = spread_lookup(with_key, dim, key, heavy).select(*fact.columns, *extra)
    unknown = without.select(*fact.columns, *[F.lit(None).cast(types[c]).alias(c) for c in extra])
    return known.unionByName(unknown)


def title_fallback(mode: str, key: str = "movie_id", title: str = "title") -> dict:
    """Defaults for a missing title: ``key`` shows the id, ``unknown`` a word."""
    if mode == "key":
        return {title: F.col(key).cast("string")}
    if mode == "unknown":
        return {title: F.lit("Unknown")}
    if mode == "drop":
        return {}
    raise ValueError(f"unknown on_missing mode {mode!r}")
