"""The trailing window every mart reports on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PURCHASED = "order_purchase_timestamp"


def window_start(orders: DataFrame) -> DataFrame:
    """One row: six months before the newest purchase of all orders (month ends are clamped)."""
    newest = F.max(PURCHASED)
    return orders.agg((newest - F.expr("INTERVAL '6' MONTH")).alias("window_start"))


def recent(orders: DataFrame, start: Column | None = None) -> DataFrame:
    """Orders purchased on or after the window start; those without a purchase time fall out.

    The start is a scalar subquery, so the bound reaches the scan as a pushed filter.
    """
    bound = window_start(orders).scalar() if start is None else start
    return orders.filter(F.col(PURCHASED) >= bound)
