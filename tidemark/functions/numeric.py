"""Numeric column helpers.

Rounding goes through DECIMAL so that a value that sits exactly on a tie (a
mean of four 4-place prices often does) rounds half away from zero, the same in
Spark, DuckDB and the warehouse SQL the models were written for. Plain
``round(double)`` disagrees between engines on such ties.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Wide enough for prices, spreads and percentages. A double that does not fit
# (1e18 and more, infinities) has no fourth decimal and stays as it is.
_ROUND_TYPE = DecimalType(28, 10)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_away(c, places: int) -> Column:
    """``round(x, n)`` with half-away-from-zero ties; NaN gives NULL."""
    x = _col(c)
    return F.coalesce(F.round(x.try_cast(_ROUND_TYPE), places).cast("double"),
                      nan_to_null(x.cast("double")))


def nan_to_null(c) -> Column:
    """NaN -> NULL (Spark orders NaN above every number, so strip it early)."""
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def guarded_pct_change(current, base, places: int) -> Column:
    """Percent change from ``base``; NULL unless ``base > 0`` (no ANSI error)."""
    cur, b = _col(current), _col(base)
    return F.when(b > 0, round_half_away((cur - b) / b * 100, places))


def label_by_thresholds(c, bands: Sequence[tuple[float, str]], otherwise: str,
                        null_label: str | None = None) -> Column:
    """Searched CASE with strict ``>`` tests, first match wins.

    ``bands`` is a list of (threshold, label) checked in the given order.
    NULL input falls through to ``otherwise`` (SQL ``ELSE`` semantics) unless
    ``null_label`` is given.
    """
    x = _col(c)
    expr = None
    for threshold, label in bands:
        expr = (F.when(x > F.lit(threshold), F.lit(label)) if expr is None
                else expr.when(x > F.lit(threshold), F.lit(label)))
    expr = F.lit(otherwise) if expr is None else expr.otherwise(F.lit(otherwise))
    if null_label is not None:
        expr = F.when(x.isNull(), F.lit(null_label)).otherwise(expr)
    return expr
