"""Rows that break a declared constraint, set apart with the names of what they break."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.functions.keys import incomplete
from feira.functions.text import fits
from feira.operators.constraints import foreign_key_violations, key_copies, repeated_keys
from feira.specs import TableSpec, parents_first

REASONS = "broken_constraints"


def own_reasons(spec: TableSpec) -> Column:
    """Names of the constraints that a row breaks by itself: NULL keys and wide text."""
    tests = [(f"{spec.name}_key_not_null", incomplete(spec.primary_key))]
    tests += [(f"{spec.name}_{c}_width", ~fits(F.col(c), n)) for c, n in spec.widths.items()]
    return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests]))


def _marked(df: DataFrame, keys: DataFrame, columns: Sequence[str], name: str, where: Column | None = None) -> DataFrame:
    """`df` with `name` among the reasons of the rows whose `columns` are one of `keys`.

    The keys end a stage: few are broadcast, and with many of them AQE splits one that most rows share.
    """
    found = keys.select(*columns, F.lit(name).alias("_reason")).hint("rebalance")
    joined = df.join(found, list(columns), "left")
    reason = F.col("_reason") if where is None else F.when(where, F.col("_reason"))
    return joined.select(
        *[df[c] for c in df.columns if c != REASONS],
        F.array_compact(F.concat(F.col(REASONS), F.array(reason))).alias(REASONS),
    )


def marked_rows(
    df: DataFrame,
    spec: TableSpec,
    parents: Mapping[str, DataFrame],
    present: DataFrame | None = None,
) -> DataFrame:
    """All rows of a table with `broken_constraints`, an array in the order key, text, references.

    Of several rows with one key, counted without those that break a constraint by themselves, each
    one is marked, as none is known to be right. A reference is looked up in `parents`, a NULL part
    passes. With rows that are `present`, to which these are to be added, their keys must be new.
    """
    key = list(spec.primary_key)
    rows = df.withColumn(REASONS, own_reasons(spec))
    single = F.size(REASONS) == 0
    twice = key_copies(rows.filter(single), key).filter("copies > 1")
    marked = _marked(rows, twice, key, f"{spec.name}_key_unique", single)
    if present is not None:
        marked = _marked(marked, repeated_keys(df, present, key), key, f"{spec.name}_key_new")
    for fk in spec.foreign_keys:
        lost = foreign_key_violations(df, fk.columns, parents[fk.parent], fk.parent_columns)
        marked = _marked(marked, lost, fk.columns, f"{spec.name}_{fk.parent}_reference")
    return marked


def kept_rows(marked: DataFrame) -> DataFrame:
    return marked.filter(F.size(REASONS) == 0).drop(REASONS)


def rejected_rows(marked: DataFrame) -> DataFrame:
    return marked.filter(F.size(REASONS) > 0)


def quarantine(
    tables: Mapping[str, DataFrame],
    specs: Sequence[TableSpec],
    present: Mapping[str, DataFrame] | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = lambda df, label: df,
    suspects: set[str] | None = None,
    new_keys: bool = True,
) -> dict[str, DataFrame]:
    """`marked_rows` of every table, so that the rows without marks keep all constraints together.

    A row that is taken out takes out the rows that refer to it. The declared references have no
    cycle, so marking parents before children reaches the end of this in one round over the tables.
    With `suspects`, the names of tables that break something, tables that neither are among them nor refer to such
    are left as they are, and not in the result. `keep(df, label)` may store each marked table. Keys that are
    present are no fault where `new_keys` is false, as rows are to be replaced.
    """
    present, known = present or {}, dict(tables)
    result: dict[str, DataFrame] = {}
    for group in parents_first(tuple(specs)):
        for spec in group:
            touched = suspects is None or spec.name in suspects or any(fk.parent in result for fk in spec.foreign_keys)
            if touched:
                old = present.get(spec.name) if new_keys else None
                marked = marked_rows(tables[spec.name], spec, known, old)
                result[spec.name] = keep(marked, f"marked-{spec.name}")
                known[spec.name] = kept_rows(result[spec.name])
            if spec.name in present:
                columns = known[spec.name].columns
                known[spec.name] = known[spec.name].unionByName(present[spec.name].select(*columns))
    return result
