"""Completing parent tables so that every reference finds a row."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.functions.keys import complete
from feira.specs import ForeignKey, TableSpec

Child = tuple[DataFrame, Sequence[str]]


def key_set(children: Iterable[Child], key: Sequence[str]) -> DataFrame:
    """The distinct complete keys of all children, under the parent's column names.

    `distinct` drops repeats inside each input task first, so a key that many rows share is
    shuffled once per task, not once per row.
    """
    keys = [
        df.select(*[df[c].alias(k) for c, k in zip(columns, key, strict=True)]).filter(complete(key))
        for df, columns in children
    ]
    return reduce(DataFrame.unionByName, keys).distinct()


def missing_keys(parent: DataFrame, key: Sequence[str], children: Iterable[Child]) -> DataFrame:
    """Keys the children use and `parent` lacks.

    The keys of all children are joined at once: the parent is read one time, not once per child.
    Both sides are distinct before the join, so no key is hot in it.
    """
    known = parent.select(*key).filter(complete(key)).distinct()
    return key_set(children, key).join(known, list(key), "left_anti")


def reference_name(spec: TableSpec, fk: ForeignKey) -> str:
    return f"{spec.name}_{fk.parent}_reference"


def reference_counts(child: DataFrame, spec: TableSpec) -> DataFrame:
    """(reference, keys, child_rows): each complete key of every reference of a table, as texts, with its number of rows.

    All references come from one scan, and keys combine inside each input task, so that what follows need not read the table again.
    """
    uses = [
        F.when(
            complete(fk.columns),
            F.struct(
                F.lit(reference_name(spec, fk)).alias("reference"),
                F.array(*[F.col(c).cast("string") for c in fk.columns]).alias("keys"),
            ),
        )
        for fk in spec.foreign_keys
    ]
    # A row of NULLs where a key is not complete.
    used = child.select(F.inline(F.array(*uses))).filter("reference IS NOT NULL")
    return used.groupBy("reference", "keys").agg(F.count("*").alias("child_rows"))


def counted_keys(counts: DataFrame, name: str, key: Sequence[str]) -> DataFrame:
    """The keys of one reference under the parent's column names, and `child_rows`."""
    own = counts.filter(F.col("reference") == name)
    return own.select(*[F.col("keys")[i].alias(k) for i, k in enumerate(key)], "child_rows")


def stub_rows(keys: DataFrame, parent: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key with the parent's columns, NULL outside the key."""
    return keys.select(
        *[
            (F.col(f.name) if f.name in key else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in parent.schema
        ]
    )


def backfill(parent: DataFrame, key: Sequence[str], children: Iterable[Child]) -> DataFrame:
    """`parent` and a stub row for each missing key."""
    missing = missing_keys(parent, key, children)
    return parent.unionByName(stub_rows(missing, parent, key))


def zip_dimension(geolocation: DataFrame, customers: DataFrame, sellers: DataFrame) -> DataFrame:
    """Distinct (prefix, city, state): all of `geolocation`, and the complete ones of the others.

    The key is the whole row here, so completing the parent is a set union and needs no join.
    """
    names = ("zip_code_prefix", "zip_city", "zip_state")

    def triples(df: DataFrame, kind: str) -> DataFrame:
        columns = (f"{kind}_zip_code_prefix", f"{kind}_city", f"{kind}_state")
        return df.select(*[df[c].alias(n) for c, n in zip(columns, names)])

    used = triples(customers, "customer").union(triples(sellers, "seller")).filter(complete(names))
    return triples(geolocation, "geolocation").union(used).distinct()
