"""Key, reference and width checks as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.functions.keys import complete, incomplete
from feira.functions.text import fits
from feira.operators.backfill import counted_keys, reference_name
from feira.specs import ForeignKey, TableSpec


def primary_key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by several rows or with a NULL part, with their number of rows.

    Counting combines inside each input task, so a key with many copies stays cheap.
    """
    copies = df.groupBy(*key).agg(F.count("*").alias("copies"))
    return copies.filter((F.col("copies") > 1) | incomplete(key))


def repeated_keys(incoming: DataFrame, present: DataFrame, key: Sequence[str]) -> DataFrame:
    """Complete keys of `incoming` that `present` has already; only keys are read and joined."""
    return key_copies(incoming, key).select(*key).join(present.select(*key), list(key), "left_semi")


def foreign_key_violations(
    child: DataFrame, columns: Sequence[str], parent: DataFrame, key: Sequence[str]
) -> DataFrame:
    """Child keys without a parent, with their number of rows; a key with a NULL part passes.

    Rows are counted per key before the join, and the parent keys are made distinct, so a key that
    holds much of either table is one row in it.
    """
    used = child.filter(complete(columns)).groupBy(*columns).agg(F.count("*").alias("child_rows"))
    known = parent.select(*[parent[k].alias(c) for c, k in zip(columns, key, strict=True)])
    known = known.filter(complete(columns)).distinct()
    return used.join(known, list(columns), "left_anti")


def orphan_rows(
    child: DataFrame, columns: Sequence[str], parent: DataFrame, key: Sequence[str]
) -> DataFrame:
    """The whole child rows whose reference finds no parent.

    The orphan keys are a stage of their own: few of them are broadcast, and with many of them AQE
    can split a key that most rows share, which it does only for inputs straight from a shuffle.
    """
    orphans = foreign_key_violations(child, columns, parent, key).select(*columns)
    return child.join(orphans.hint("rebalance"), list(columns), "left_semi")


def width_violations(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Rows with text over its declared width, and the names of the columns concerned."""
    names = [F.when(~fits(F.col(c), n), F.lit(c)) for c, n in widths.items()]
    return df.withColumn("too_wide", F.array_compact(F.array(*names))).filter(F.size("too_wide") > 0)


def _lines(counts: DataFrame, kinds: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One report line per column of the one-row frame; `kinds` gives its table and kind."""
    rows = ", ".join(
        f"'{table}', '{name}', '{kind}', coalesce({name}, 0)" for name, (table, kind) in kinds.items()
    )
    return counts.selectExpr(
        f"stack({len(kinds)}, {rows}) AS (table_name, constraint_name, kind, violations)"
    )


def column_lines(df: DataFrame, spec: TableSpec) -> DataFrame:
    """NULL keys and wide text of one table, counted in a single pass."""
    missing = " OR ".join(f"{part} IS NULL" for part in spec.primary_key)
    tests = {f"{spec.name}_key_not_null": (missing, "not_null")}
    for name, width in spec.widths.items():
        wide = f"length({name}) > {width} AND length(rtrim({name})) > {width}"
        tests[f"{spec.name}_{name}_width"] = (wide, "width")
    counts = df.selectExpr(*[f"count_if({test}) AS {name}" for name, (test, _) in tests.items()])
    return _lines(counts, {name: (spec.name, kind) for name, (_, kind) in tests.items()})


def key_copies(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The distinct complete keys with their number of rows."""
    return df.filter(complete(key)).groupBy(*key).agg(F.count("*").alias("copies"))


def key_lines(copies: DataFrame, spec: TableSpec) -> DataFrame:
    """Complete keys of one table that several rows hold."""
    name = f"{spec.name}_key_unique"
    return _lines(copies.selectExpr(f"count_if(copies > 1) AS {name}"), {name: (spec.name, "primary_key")})


def reference_lines(
    parent_keys: DataFrame,
    tables: Mapping[str, DataFrame],
    users: Sequence[tuple[TableSpec, ForeignKey]],
    counts: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Child rows without a parent row, for all references to one parent's `key_copies`.

    The children are counted per key together, so the parent is joined once. Children whose `reference_counts` are
    among `counts` are not read.
    """
    key = users[0][1].parent_columns
    names = {reference_name(spec, fk): (spec, fk) for spec, fk in users}
    used = []
    for name, (spec, fk) in names.items():
        if counts and spec.name in counts:
            rows = counted_keys(counts[spec.name], name, key)
        else:
            given = tables[spec.name].filter(complete(fk.columns))
            rows = given.selectExpr(*[f"{c} AS {k}" for c, k in zip(fk.columns, key)], "1L AS child_rows")
        used.append(rows.withColumn("reference", F.lit(name)))
    sums = [F.expr(f"sum(if(reference = '{name}', child_rows, 0L)) AS {name}") for name in names]
    per_key = reduce(DataFrame.unionByName, used).groupBy(*key).agg(*sums)
    # The test on the count keeps the aggregate as the uniqueness check has it, so both share a shuffle.
    known = parent_keys.filter("copies > 0").select(*key)
    lost = per_key.join(known, list(key), "left_anti")
    totals = lost.selectExpr(*[f"sum({name}) AS {name}" for name in names])
    return _lines(totals, {name: (spec.name, "foreign_key") for name, (spec, _) in names.items()})


def present_lines(copies: DataFrame, present: DataFrame, spec: TableSpec) -> DataFrame:
    """Incoming keys of one table that are in it already."""
    name, key = f"{spec.name}_key_new", list(spec.primary_key)
    old = copies.select(*key).join(present.select(*key), key, "left_semi")
    return _lines(old.selectExpr(f"count(*) AS {name}"), {name: (spec.name, "primary_key")})


def stored_reference_lines(
    counts: DataFrame, parents: Mapping[str, DataFrame], specs: Sequence[TableSpec]
) -> DataFrame:
    """The report lines of all references from stored `reference_counts` and the keys of the parents alone.

    `counts` may hold several rows for a key, which are added up, as appends and updates leave them.
    """
    every = counts.groupBy("reference", "keys").agg(F.sum("child_rows").alias("child_rows")).filter("child_rows > 0")
    users: dict[str, list[tuple[TableSpec, ForeignKey]]] = {}
    for spec in specs:
        for fk in spec.foreign_keys:
            users.setdefault(fk.parent, []).append((spec, fk))
    lines = []
    for parent, group in users.items():
        key = group[0][1].parent_columns
        known = key_copies(parents[parent].select(*[F.col(c).cast("string").alias(c) for c in key]), key)
        lines.append(reference_lines(known, {}, group, dict.fromkeys([spec.name for spec, _ in group], every)))
    return reduce(DataFrame.unionByName, lines)


def constraint_report(
    tables: Mapping[str, DataFrame],
    specs: Sequence[TableSpec],
    present: Mapping[str, DataFrame] | None = None,
    new_keys: bool = True,
    counts: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """(table_name, constraint_name, kind, violations) for every declared constraint.

    With tables that are `present`, to which these are to be added, rows that are present count as
    parents, and the keys must be new, unless `new_keys` is false as rows are to be replaced. References of
    tables whose `reference_counts` are among `counts` are checked by these.
    """
    present = present or {}
    copies = {spec.name: key_copies(tables[spec.name], spec.primary_key) for spec in specs}
    users: dict[str, list[tuple[TableSpec, ForeignKey]]] = {}
    lines = []
    for spec in specs:
        lines += [column_lines(tables[spec.name], spec), key_lines(copies[spec.name], spec)]
        if spec.name in present and new_keys:
            lines.append(present_lines(copies[spec.name], present[spec.name], spec))
        for fk in spec.foreign_keys:
            users.setdefault(fk.parent, []).append((spec, fk))
    for parent, group in users.items():
        known = copies[parent]
        if parent in present:
            known = known.unionByName(key_copies(present[parent], group[0][1].parent_columns))
        lines.append(reference_lines(known, tables, group, counts))
    return reduce(DataFrame.unionByName, lines)
