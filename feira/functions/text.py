"""Text against its declared width."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.specs import TableSpec


def fits(text: Column, width: int) -> Column:
    """True if `text` has at most `width` characters, spaces at the end not counted."""
    return (F.length(text) <= width) | (F.length(F.rtrim(text)) <= width)


def fit(text: Column, width: int) -> Column:
    """`text` without the trailing spaces beyond `width`; text that is too long stays whole."""
    spaces_only = (F.length(text) > width) & (F.length(F.rtrim(text)) <= width)
    return F.when(spaces_only, F.substring(text, 1, width)).otherwise(text)


def fit_all(df: DataFrame, spec: TableSpec) -> DataFrame:
    """`fit` on every column of `df` that has a declared width."""
    return df.withColumns({name: fit(df[name], width) for name, width in spec.widths.items()})
