"""The first rows of a result, in a defined order (``show()`` had none)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ordered_preview(df: DataFrame, order_by, n: int = 20) -> DataFrame:
    """Top ``n`` rows by ``order_by``: each task keeps its own top ``n``, one task merges
    them (TakeOrderedAndProject), so nothing but ``n`` rows per task moves."""
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*[F.col(k) if isinstance(k, str) else k for k in keys]).limit(n)
