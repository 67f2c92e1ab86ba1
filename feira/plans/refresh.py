"""The whole run: raw files to raw tables, clean tables and marts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from contextlib import nullcontext
from dataclasses import dataclass, replace
from functools import partial, reduce
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from feira.functions.text import fit_all
from feira.operators.backfill import reference_counts
from feira.operators.constraints import (
    constraint_report,
    primary_key_violations,
    repeated_keys,
    stored_reference_lines,
)
from feira.operators.quarantine import REASONS, kept_rows, quarantine, rejected_rows
from feira.plans.clean import clean_tables, raw_counts
from feira.plans.marts import DELIVERED, all_marts
from feira.sources.layers import CatalogLayer, JdbcLayer, ParquetLayer
from feira.sources.ledger import AppendLedger, fingerprint
from feira.sources.parallel import run_all
from feira.sources.raw import (
    RECORD,
    UNREADABLE,
    drop_incomplete,
    is_incomplete,
    read_checked,
)
from feira.sources.scratch import keep, keep_all, scratch_of_run
from feira.sources.versions import VersionedLayer
from feira.specs import CLEAN, MARTS, RAW, Column, TableSpec, parents_first

Layer = ParquetLayer | CatalogLayer | JdbcLayer | VersionedLayer

LINES = (
    Column("table_name", StringType(), "VARCHAR(64)"),
    Column("constraint_name", StringType(), "VARCHAR(128)"),
    Column("kind", StringType(), "VARCHAR(16)"),
    Column("violations", LongType(), "BIGINT"),
)
REPORT = TableSpec("constraint_report", LINES)
# The same lines on the raw files: rows with text that cannot be read, reviews without their dates.
LOADED = TableSpec("load_report", LINES)
# Reviews without dates are left out by design, and rejected rows on request, so they stop no run.
HARMLESS = ("incomplete", "rejected")


# Number of child rows per key of every reference, kept beside the clean tables. Loads add rows to it, also
# negative ones for child rows that are replaced; a key's number is their sum.
COUNTS = TableSpec(
    "reference_counts",
    (
        Column("reference", StringType(), "VARCHAR(128)"),
        Column("keys", ArrayType(StringType()), "TEXT"),
        Column("child_rows", LongType(), "BIGINT"),
    ),
)


def unreadable_rows(spec: TableSpec) -> TableSpec:
    """The table of an entity's rows that could not be read whole, beside its raw table."""
    return TableSpec(
        f"{spec.name}_unreadable",
        (Column("column_names", StringType(), "VARCHAR(512)"), Column("record", StringType(), "TEXT")),
    )


def rejected(spec: TableSpec) -> TableSpec:
    """The table of an entity's rows that break a constraint, beside its clean table."""
    return TableSpec(f"{spec.name}_rejected", (*spec.columns, Column(REASONS, StringType(), "VARCHAR(1024)")))


class ConstraintViolation(ValueError):
    """Clean tables break a declared constraint; no clean table was written."""


class RepeatedKeys(ConstraintViolation):
    """Rows to append have keys that the table has already; nothing was written."""


def append_rows(layer: Layer, df: DataFrame, spec: TableSpec) -> None:
    """Add rows to a table of a layer, unless a key of theirs is in it or occurs twice among them."""
    spark, key = df.sparkSession, list(spec.primary_key)
    present = layer.find(spark, spec)
    twice = primary_key_violations(df, key).select(*key)
    refused = twice if present is None else twice.union(repeated_keys(df, present, key))
    count = refused.distinct().count()
    if count:
        raise RepeatedKeys(f"{spec.name}: {count} keys")
    layer.write(df, spec, "append")


def upsert_rows(layer: ParquetLayer | VersionedLayer, df: DataFrame, spec: TableSpec) -> list[str]:
    """Bring changed and new rows into a table; returns the files replaced.

    A key that occurs twice among the rows, or has a NULL part, is refused: which row would count is not known.
    """
    refused = primary_key_violations(df, list(spec.primary_key)).count()
    if refused:
        raise RepeatedKeys(f"{spec.name}: {refused} keys")
    return layer.upsert(df, spec)


@dataclass(frozen=True)
class Layers:
    raw: Layer
    clean: Layer
    marts: Layer

    @staticmethod
    def parquet(root: str) -> Layers:
        return Layers(*[ParquetLayer(f"{root.rstrip('/')}/{name}") for name in ("raw", "clean", "marts")])

    @staticmethod
    def versioned(root: str) -> Layers:
        """Raw tables one by one; the clean tables change together, and so do the marts."""
        kinds = (("raw", ParquetLayer), ("clean", VersionedLayer), ("marts", VersionedLayer))
        return Layers(*[kind(f"{root.rstrip('/')}/{name}") for name, kind in kinds])


def load_raw(
    spark: SparkSession, source: str, layer: Layer, quote_escape: str = '"'
) -> DataFrame:
    """Every raw file into the raw layer, replacing what was there; returns the load report.

    Text is fitted to its declared width here, so that later filters on it reach the scans. Rows with
    text that does not fit its column stay in their table, with NULL there; they are counted in the
    report while the table is written, and if there are any, written as text to a table of their own.
    """

    def load(spec: TableSpec) -> list[tuple[str, str, str, int]]:
        checked = read_checked(spark, spec, f"{source.rstrip('/')}/{spec.source}", quote_escape)
        seen = Observation(f"load {spec.name}")
        watched = checked.observe(
            seen,
            F.count_if(F.size(UNREADABLE) > 0).alias("unreadable"),
            F.count_if(is_incomplete(spec)).alias("incomplete"),
        )
        # Unsorted: ordering would compute the rows twice. The clean table is sorted.
        layer.write(fit_all(drop_incomplete(watched, spec), spec), replace(spec, sorted_by=()))
        counts, rejected = seen.get, unreadable_rows(spec)
        if counts["unreadable"] or (not isinstance(layer, JdbcLayer) and layer.find(spark, rejected)):
            rows = checked.filter(F.size(UNREADABLE) > 0)
            names = F.array_join(UNREADABLE, ",").alias("column_names")
            layer.write(rows.select(names, F.col(RECORD).alias("record")), rejected)
        lines = [(spec.name, f"{spec.name}_readable", "unreadable", counts["unreadable"])]
        if spec.required:
            lines.append((spec.name, f"{spec.name}_complete", HARMLESS[0], counts["incomplete"]))
        return lines

    with scratch_of_run(spark):
        found = run_all(partial(load, spec) for spec in RAW)
    report = spark.createDataFrame([line for lines in found for line in lines], LOADED.schema)
    layer.write(report, LOADED)
    return report


def _set_apart(
    tables: Mapping[str, DataFrame], present: Mapping[str, DataFrame], suspects: set[str], new_keys: bool
) -> dict[str, DataFrame]:
    """Marked tables with at least one of `suspects` above them or the same; nothing without suspects."""
    return quarantine(tables, CLEAN, present, keep, suspects, new_keys) if suspects else {}


def _write_rejected(
    spark: SparkSession, layer: Layer, taken_out: Mapping[str, DataFrame], mode: str, done: Sequence[str]
) -> None:
    """The rejected rows of each table; tables of an earlier run are emptied where nothing is rejected now."""
    for spec in CLEAN:
        target = rejected(spec)
        if target.name in done:
            continue
        if spec.name in taken_out:
            rows = rejected_rows(taken_out[spec.name])
            layer.write(rows.withColumn(REASONS, F.array_join(REASONS, ",")), target, "append" if mode != "overwrite" else mode)
        elif mode == "overwrite" and not isinstance(layer, JdbcLayer) and layer.find(spark, target) is not None:
            layer.write(spark.createDataFrame([], target.schema), target)


def _present(spark: SparkSession, layer: Layer, spec: TableSpec, ledger: AppendLedger | None) -> DataFrame | None:
    """The rows of a table before the append; None if there is no table."""
    df = layer.find(spark, spec)
    if df is None or ledger is None or spec.name not in ledger.done:
        return df
    files = [f"{layer.path(spec)}/{name}" for name in ledger.before[spec.name]]
    return spark.read.schema(spec.schema).parquet(*files) if files else None


def _together(spark: SparkSession, layer: Layer):
    """Where to write tables that belong together."""
    return layer.change(spark) if isinstance(layer, VersionedLayer) else nullcontext(layer)


def _new_counts(
    tables: Mapping[str, DataFrame],
    counts: Mapping[str, DataFrame],
    present: Mapping[str, DataFrame],
    mode: str,
) -> DataFrame:
    """What a load adds to the key counts; rows that an upsert replaces are subtracted."""
    parts = []
    for spec in CLEAN:
        if not spec.foreign_keys:
            continue
        # Stub rows refer to nothing, so the counts of the raw rows are those of the clean ones.
        parts.append(counts[spec.name] if spec.name in counts else reference_counts(tables[spec.name], spec))
        if mode == "upsert" and spec.name in present:
            key = list(spec.primary_key)
            gone = present[spec.name].join(tables[spec.name].select(*key).distinct(), key, "left_semi")
            parts.append(reference_counts(gone, spec).withColumn("child_rows", -F.col("child_rows")))
    return reduce(DataFrame.unionByName, parts)


def audit_references(spark: SparkSession, layer: Layer) -> DataFrame:
    """The report lines of all references of a clean layer, from its key counts: no child table is read."""
    parents = {fk.parent for spec in CLEAN for fk in spec.foreign_keys}
    known = {spec.name: layer.read(spark, spec) for spec in CLEAN if spec.name in parents}
    return stored_reference_lines(layer.read(spark, COUNTS), known, CLEAN)


def load_clean(
    spark: SparkSession,
    layers: Layers,
    on_violation: str = "fail",
    mode: str = "overwrite",
    loaded: DataFrame | None = None,
) -> DataFrame:
    """Raw layer to clean layer, parents first; returns the constraint report.

    Constraints are checked before the first clean table is written, and the report, with the lines of
    `loaded`, is written beside the marts whatever it says. With ``on_violation="fail"`` any violation
    then stops the run; with ``"report"`` the tables are written all the same. With ``"quarantine"``
    the rows that break a constraint, and those that refer to them, go to tables of their own
    (`rejected`) with the names of what they break. The rest is checked again and written; the
    report then is that of the rest, with the number of rejected rows per table.

    ``mode="append"`` adds to the clean tables that exist: a key that is there already is a violation,
    rows there count as parents, and location ids go on after the largest one. ``mode="upsert"`` (Parquet
    layers) does the same, but a row whose key is there takes the place of that row.

    An append to Parquet tables that was cut off is finished by the next one with the same raw tables: what it had
    added is not added again. One with other raw tables first takes out what the unfinished one had added. In a
    `VersionedLayer` all tables change at once.
    """
    with scratch_of_run(spark):
        present, ledger = {}, None
        if mode == "append" and isinstance(layers.clean, ParquetLayer):
            inputs = [layers.raw.path(spec) for spec in RAW] if isinstance(layers.raw, ParquetLayer) else []
            # Without files to know the input by, each run is one of its own.
            run = fingerprint(spark, inputs) if inputs else uuid4().hex
            kinds = [*CLEAN, *map(rejected, CLEAN), COUNTS]
            ledger = AppendLedger.open(spark, layers.clean.root, run, [spec.name for spec in kinds])
        if mode != "overwrite":
            found = {spec.name: _present(spark, layers.clean, spec, ledger) for spec in CLEAN}
            present = {name: df for name, df in found.items() if df is not None}
        raw = {spec.name: layers.raw.read(spark, spec) for spec in RAW}
        counts = keep_all(raw_counts(raw))
        tables = clean_tables(raw, keep_all, present, counts)
        new_keys = mode == "append"
        report = keep(constraint_report(tables, CLEAN, present, new_keys, counts), "constraint-report")
        taken_out = {}
        if on_violation == "quarantine":
            suspects = {r.table_name for r in report.filter("violations > 0").select("table_name").distinct().collect()}
            taken_out = _set_apart(tables, present, suspects, new_keys)
            if taken_out:
                tables |= {name: kept_rows(marked) for name, marked in taken_out.items()}
                counts = {name: df for name, df in counts.items() if name not in taken_out}
                rejections = [
                    marked.agg(
                        F.lit(name).alias("table_name"),
                        F.lit(f"{name}_accepted").alias("constraint_name"),
                        F.lit(HARMLESS[1]).alias("kind"),
                        F.count_if(F.size(REASONS) > 0).alias("violations"),
                    )
                    for name, marked in taken_out.items()
                ]
                rest = constraint_report(tables, CLEAN, present, new_keys, counts)
                report = reduce(DataFrame.unionByName, rejections, rest)
        report = keep(report if loaded is None else report.unionByName(loaded), "constraint-report")
        layers.marts.write(report, REPORT)
        # One row per declared constraint at most, so fetching the broken ones is bounded.
        bad = (F.col("violations") > 0) & ~F.col("kind").isin(*HARMLESS)
        broken = report.filter(bad).orderBy("constraint_name").collect() if on_violation != "report" else []
        if broken:
            raise ConstraintViolation(", ".join(f"{r.constraint_name}: {r.violations}" for r in broken))
        with _together(spark, layers.clean) as target:

            def load(spec: TableSpec) -> None:
                if mode == "upsert":
                    upsert_rows(target, tables[spec.name], spec)
                elif ledger is None or spec.name not in ledger.done:
                    target.write(tables[spec.name], spec, mode)

            def finished(specs: Iterable[TableSpec]) -> None:
                if ledger is not None:
                    ledger.finish(spark, [spec.name for spec in specs])

            added = None
            if not isinstance(layers.clean, JdbcLayer):
                # Before the tables change, which the subtraction reads.
                added = keep(_new_counts(tables, counts, present, mode), "new-counts")
            _write_rejected(spark, target, taken_out, mode, ledger.done if ledger else ())
            finished(map(rejected, CLEAN))
            for group in parents_first():
                run_all(partial(load, spec) for spec in group)
                finished(group)
            if added is not None and (ledger is None or COUNTS.name not in ledger.done):
                target.write(added, COUNTS, "overwrite" if mode == "overwrite" else "append")
                finished([COUNTS])
        if ledger is not None:
            ledger.close(spark)
    return layers.marts.read(spark, REPORT)


def load_marts(spark: SparkSession, layers: Layers, delivered: str = DELIVERED) -> None:
    """Clean layer to marts, each replaced, so a second run gives the same tables."""
    with scratch_of_run(spark):
        clean = {spec.name: layers.clean.read(spark, spec) for spec in CLEAN}
        marts = all_marts(clean, delivered, keep)
        with _together(spark, layers.marts) as target:
            run_all(partial(target.write, marts[spec.name], spec) for spec in MARTS)


def refresh(
    spark: SparkSession,
    source: str,
    layers: Layers,
    on_violation: str = "fail",
    delivered: str = DELIVERED,
    quote_escape: str = '"',
) -> DataFrame:
    """Raw files to marts; returns the constraint report, which is kept beside the marts."""
    loaded = load_raw(spark, source, layers.raw, quote_escape)
    report = load_clean(spark, layers, on_violation, loaded=loaded)
    load_marts(spark, layers, delivered)
    return report
