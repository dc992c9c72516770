"""Epoch-second helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts_ntz) -> Column:
    """Epoch seconds of a wall-clock (TIMESTAMP_NTZ) value read as UTC."""
    c = _col(ts_ntz)
    day = F.unix_date(c.cast("date")).cast("long")
    return day * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c).cast("long")


def year_utc(epoch) -> Column:
    """Calendar year (UTC) of epoch seconds; floor division keeps negatives right."""
    return F.year(F.date_from_unix_date(F.floor(_col(epoch) / 86400).cast("int")))
