"""Exact order statistics as aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ranked(name: str, percent: int) -> Column:
    """The smallest value of a column that at least ``percent`` of the group's values do not exceed; nulls do not count.

    Each task counts its different values and the counts are merged, in a stream too, so the buffer of a group grows with its different values and not with its rows.
    """
    return F.expr(f"percentile_disc({percent / 100}) WITHIN GROUP (ORDER BY `{name}`)")
