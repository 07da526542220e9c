"""Calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(c) -> Column:
    """Monday of the ISO week as a DATE (cast at once: date_trunc yields a timestamp)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_trunc("week", c).cast("date")
