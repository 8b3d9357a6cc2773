"""Repeated deliveries: one row for each key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys`` and ``value``, one row for each key.

    Deliveries of one key carry the same value, so any of them may stay; where they differ the greatest
    value stays, so that the result is defined.  The aggregate combines before it shuffles.
    """
    return df.groupBy(*keys).agg(F.max(value).alias(value))
