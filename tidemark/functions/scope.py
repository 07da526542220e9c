"""Restriction of a table to the rows that a model is about."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def within(df: DataFrame, scope: Mapping[str, str] | None) -> DataFrame:
    """Rows whose columns equal the values of ``scope`` (None: all rows), e.g.
    ``{"region": "US_NATIONAL"}`` for the models of the national series."""
    for column, value in (scope or {}).items():
        df = df.filter(F.col(column) == F.lit(value))
    return df
