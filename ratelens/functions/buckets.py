"""Numeric bucketing into labelled groups (age groups)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Buckets:
    """Ordered cuts ``(label, op, bound)`` tried in turn; ``rest`` otherwise.

    ``op`` is ``"<"`` or ``"<="``. NULL input gives NULL."""
    cuts: tuple
    rest: str

    @property
    def labels(self) -> list[str]:
        return [c[0] for c in self.cuts] + [self.rest]


# The two age-group presets of the reference programs.
# Four groups, upper bounds inclusive (age 18 -> "0-18").
AGE_GROUPS_4 = Buckets(cuts=(("0-18", "<=", 18), ("18-35", "<=", 35), ("35-50", "<=", 50)), rest="50+")
# Five groups, first bound exclusive (age 18 -> "18-25").
AGE_GROUPS_5 = Buckets(
    cuts=(("Under18", "<", 18), ("18-25", "<=", 25), ("26-35", "<=", 35), ("36-50", "<=", 50)),
    rest="50+",
)

PRESETS = {"four": AGE_GROUPS_4, "five": AGE_GROUPS_5}


def bucketize(c, buckets: Buckets | str) -> Column:
    if isinstance(buckets, str):
        buckets = PRESETS[buckets]
    c = F.col(c) if isinstance(c, str) else c
    expr = None
    for label, op, bound in buckets.cuts:
        cond = c < bound if op == "<" else c <= bound
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.when(c.isNotNull(), F.lit(buckets.rest))


def bucket_ordinal(c, buckets: Buckets | str) -> Column:
    """Position of a label in its preset, for ordering groups by age."""
    if isinstance(buckets, str):
        buckets = PRESETS[buckets]
    c = F.col(c) if isinstance(c, str) else c
    return F.array_position(F.array(*[F.lit(x) for x in buckets.labels]), c)
