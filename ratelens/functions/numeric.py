"""Rounding and numeric rendering shared by every report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round2(c) -> Column:
    """Round once, half-up, to two decimals on the shortest decimal form of
    the double (2.675 becomes 2.68, 3.00499975 becomes 3.0)."""
    return F.round(_col(c), 2)


def fixed2(c) -> Column:
    """Two-decimal string ('4.00'), rounded once; NULL stays NULL."""
    return F.when(_col(c).isNotNull(), F.format_string("%.2f", _col(c)))


def fixed2_or(c, default: str) -> Column:
    return F.coalesce(fixed2(c), F.lit(default))


def plain(c) -> Column:
    """The unrounded value in single precision as text ('4.0', '3.6666667')."""
    return _col(c).cast("float").cast("string")
