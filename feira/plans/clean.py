"""Clean tables: every reference gets a parent row, locations get ids."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from feira.operators.backfill import (
    counted_keys,
    missing_keys,
    reference_counts,
    reference_name,
    stub_rows,
    zip_dimension,
)
from feira.operators.dense_id import numbered_geolocation
from feira.specs import RAW, ZIP


def raw_counts(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """`reference_counts` of the raw tables that refer to others, but for places, of which few rows stay."""
    return {
        spec.name: reference_counts(raw[spec.name], spec)
        for spec in RAW
        if spec.foreign_keys and spec.name != "geolocation"
    }


def clean_tables(
    raw: Mapping[str, DataFrame],
    keep_all=dict,
    present: Mapping[str, DataFrame] | None = None,
    counts: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The ten clean tables from the nine raw ones; with the tables that are `present`, what they lack.

    References are looked up in the raw tables: a stub row holds nothing but its key, so it cannot
    refer to anything itself. `keep_all` may store the missing keys and the zip dimension, which
    the checks and the final write both read; `counts` are the `raw_counts` if they are stored already.
    """
    counts = raw_counts(raw) if counts is None else counts
    keys: dict[str, list[str]] = {}
    used: dict[str, list[DataFrame]] = {}
    for spec in RAW:
        for fk in spec.foreign_keys:
            if fk.parent != ZIP.name:
                keys[fk.parent] = list(fk.parent_columns)
                found = counted_keys(counts[spec.name], reference_name(spec, fk), fk.parent_columns)
                used.setdefault(fk.parent, []).append(found.drop("child_rows"))

    present = present or {}

    def known(parent: str) -> DataFrame:
        own = raw[parent].select(*keys[parent])
        return own.union(present[parent].select(*keys[parent])) if parent in present else own

    steps = {p: missing_keys(known(p), keys[p], [(df, keys[p]) for df in users]) for p, users in used.items()}
    steps["zip"] = zip_dimension(raw["geolocation"], raw["customers"], raw["sellers"])
    if "zip" in present:
        steps["zip"] = steps["zip"].subtract(present["zip"].select(*ZIP.names))
    stored = keep_all(steps)
    completed = {p: raw[p].unionByName(stub_rows(stored[p], raw[p], keys[p])) for p in used}
    return {
        **raw,
        **completed,
        "zip": stored["zip"],
        "geolocation": numbered_geolocation(raw["geolocation"], present.get("geolocation")),
    }
