"""Conditions on the parts of a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def complete(key: Sequence[str]) -> Column:
    """No part is NULL. Written as IS NOT NULL tests, which the scan takes over."""
    return F.expr(" AND ".join(f"{part} IS NOT NULL" for part in key))


def incomplete(key: Sequence[str]) -> Column:
    """Some part is NULL."""
    return F.expr(" OR ".join(f"{part} IS NULL" for part in key))
