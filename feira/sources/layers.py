"""Table layers: Parquet folders by default, catalog tables or JDBC as options."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.sources.files import delete, exists, make_folder, move, names, read_text, replace, write_text
from feira.sources.scratch import keep
from feira.specs import TableSpec

# Folder of an update that is being written, hidden from Spark, and the file in it that says what is to be done.
_STAGED, _PLAN = "_update-", "_plan.json"


@dataclass(frozen=True)
class ParquetLayer:
    """One folder per table under `root`.

    A table that is overwritten is written beside the old one and takes its place when it is complete.
    """

    root: str

    def path(self, spec: TableSpec) -> str:
        return f"{self.root.rstrip('/')}/{spec.name}"

    def read(self, spark: SparkSession, spec: TableSpec) -> DataFrame:
        return spark.read.schema(spec.schema).parquet(self.path(spec))

    def find(self, spark: SparkSession, spec: TableSpec) -> DataFrame | None:
        """The table, or None if it does not exist."""
        return self.read(spark, spec) if exists(spark, self.path(spec)) else None

    @staticmethod
    def placed(table: DataFrame, spec: TableSpec) -> DataFrame:
        """The rows as they are written: in ranges of the columns the table is sorted by, if any."""
        if not spec.sorted_by:
            return table
        # Each file gets a range of the column, so a scan for a range opens few files. The key
        # spreads the rows that share a value or have none.
        order = (*spec.sorted_by, *[c for c in spec.primary_key if c not in spec.sorted_by])
        return table.repartitionByRange(*order).sortWithinPartitions(*order)

    def write(self, df: DataFrame, spec: TableSpec, mode: str = "overwrite") -> None:
        self.finish_updates(df.sparkSession, spec)
        table = self.placed(conform(df, spec), spec)
        if mode != "overwrite":
            table.write.mode(mode).parquet(self.path(spec))
            return
        spark, new = df.sparkSession, f"{self.root.rstrip('/')}/_new-{spec.name}-{uuid4().hex}"
        try:
            table.write.parquet(new)
            replace(spark, new, self.path(spec))
        finally:
            delete(spark, new)


    def upsert(self, df: DataFrame, spec: TableSpec) -> list[str]:
        """Put rows in the place of those with the same key, and add the others; returns the files replaced.

        Only files that hold a key of `df` are written anew, each row but those replaced. The keys in
        `df` must be complete and tell its rows apart. All rows of the table that share a key of `df` go. The new
        files are written beside the table; then a plan of what to move and delete, which a later
        writer carries out if this one dies; then the old files go and the new ones come. A reader in between sees
        fewer rows, never two of one key. One writer at a time.
        """
        spark, key = df.sparkSession, list(spec.primary_key)
        new = keep(conform(df, spec), f"upsert-{spec.name}")
        self.finish_updates(spark, spec)
        path, staged = self.path(spec), f"{self.root.rstrip('/')}/{_STAGED}{spec.name}-{uuid4().hex}"
        rows, old = new, []
        if exists(spark, path):
            keys = new.select(*key)
            held = self.read(spark, spec).select(*key, F.col("_metadata.file_path").alias("file"))
            # Names of files, not rows.
            old = [r.file for r in held.join(keys, key, "left_semi").select("file").distinct().collect()]
            if old:
                rest = spark.read.schema(spec.schema).parquet(*old).join(keys, key, "left_anti")
                rows = rest.select(*spec.names).unionByName(new)
        self.placed(rows, spec).write.parquet(staged)
        write_text(spark, f"{staged}/{_PLAN}", json.dumps({"old": old, "new": names(spark, staged, "part-")}))
        self.finish_updates(spark, spec)
        return old

    def finish_updates(self, spark: SparkSession, spec: TableSpec) -> None:
        """Carry out the plan of an update that was cut off; without a plan, drop what it has written."""
        root = self.root.rstrip("/")
        for name in names(spark, root, f"{_STAGED}{spec.name}-"):
            plan = read_text(spark, f"{root}/{name}/{_PLAN}")
            if plan is not None:
                steps = json.loads(plan)
                for file in steps["old"]:
                    delete(spark, file)
                make_folder(spark, self.path(spec))
                for file in steps["new"]:
                    move(spark, f"{root}/{name}/{file}", f"{self.path(spec)}/{file}")
            delete(spark, f"{root}/{name}")


@dataclass(frozen=True)
class CatalogLayer:
    """Parquet tables of the session catalog.

    With `buckets`, tables are stored hashed and sorted by their key, so that later joins and sums
    by that key start without a shuffle. The write shuffles once to give each bucket one file.
    Meant for tables that passed the constraint checks: the declared key bounds the rows per value.
    """

    database: str
    prefix: str = ""
    buckets: int | None = None

    def name(self, spec: TableSpec) -> str:
        return f"{self.database}.{self.prefix}{spec.name}"

    def read(self, spark: SparkSession, spec: TableSpec) -> DataFrame:
        return spark.table(self.name(spec))

    def find(self, spark: SparkSession, spec: TableSpec) -> DataFrame | None:
        """The table, or None if it does not exist."""
        return self.read(spark, spec) if spark.catalog.tableExists(self.name(spec)) else None

    def write(self, df: DataFrame, spec: TableSpec, mode: str = "overwrite") -> None:
        table = conform(df, spec)
        if self.buckets and spec.bucketed_by:
            placed = table.repartition(self.buckets, *spec.bucketed_by)
            writer = placed.write.bucketBy(self.buckets, *spec.bucketed_by).sortBy(*spec.bucketed_by)
        else:
            writer = table.write
        writer.mode(mode).format("parquet").saveAsTable(self.name(spec))


@dataclass(frozen=True)
class RangeSplit:
    """Even ranges of a numeric or timestamp column, one reading task each."""

    column: str
    lower: str
    upper: str
    partitions: int


@dataclass(frozen=True)
class JdbcLayer:
    """Tables of a database; `options` carries user, password and driver.

    With `declared_types`, tables that do not exist yet are created with the declared column types,
    and the blanks a database adds to CHAR values are taken off on reading. Without it they get
    Spark's own types, which take text of any width: right for raw tables.

    `splits` says by table name how a table is read in several tasks, as a column range or a list of
    disjoint WHERE conditions; a table without a split is read in one. `table_writers` likewise sets
    the number of connections that write a table, where it is not `writers`.
    """

    url: str
    prefix: str = ""
    declared_types: bool = False
    options: dict[str, str] = field(default_factory=dict, repr=False)
    fetch_rows: int = 10_000
    batch_rows: int = 10_000
    writers: int | None = None
    splits: Mapping[str, RangeSplit | Sequence[str]] = field(default_factory=dict)
    table_writers: Mapping[str, int] = field(default_factory=dict)

    def table(self, spec: TableSpec) -> str:
        return f"{self.prefix}{spec.name}"

    def read_options(self, spec: TableSpec, split: RangeSplit | None = None) -> dict[str, str]:
        chosen = {
            "url": self.url,
            "dbtable": self.table(spec),
            "fetchsize": str(self.fetch_rows),
            "preferTimestampNTZ": "true",
            **self.options,
        }
        if split is not None:
            chosen |= {
                "partitionColumn": split.column,
                "lowerBound": split.lower,
                "upperBound": split.upper,
                "numPartitions": str(split.partitions),
            }
        return chosen

    def read(
        self,
        spark: SparkSession,
        spec: TableSpec,
        split: RangeSplit | Sequence[str] | None = None,
    ) -> DataFrame:
        """The whole table; `split` takes the place of the one in `splits`."""
        split = self.splits.get(spec.name) if split is None else split
        if split is None or isinstance(split, RangeSplit):
            df = spark.read.format("jdbc").options(**self.read_options(spec, split)).load()
        else:
            properties = self.read_options(spec)
            url, table = properties.pop("url"), properties.pop("dbtable")
            df = spark.read.jdbc(url, table, predicates=list(split), properties=properties)
        return unpad(df, spec) if self.declared_types else df

    def find(self, spark: SparkSession, spec: TableSpec) -> DataFrame:
        """The table, which has to exist."""
        return self.read(spark, spec)

    def write_options(self, spec: TableSpec, mode: str) -> dict[str, str]:
        chosen = {
            "url": self.url,
            "dbtable": self.table(spec),
            "batchsize": str(self.batch_rows),
            **self.options,
        }
        if self.declared_types:
            chosen["createTableColumnTypes"] = spec.column_types
        writers = self.table_writers.get(spec.name, self.writers)
        if writers is not None:
            chosen["numPartitions"] = str(writers)
        if mode == "overwrite":
            chosen["truncate"] = "true"
        return chosen

    def write(self, df: DataFrame, spec: TableSpec, mode: str = "overwrite") -> None:
        options = self.write_options(spec, mode)
        conform(df, spec).write.format("jdbc").options(**options).mode(mode).save()


def create_views(
    spark: SparkSession,
    layer: ParquetLayer | CatalogLayer | JdbcLayer,
    specs: Sequence[TableSpec],
    prefix: str,
) -> None:
    """The tables of a layer as temporary views, for `spark.sql`."""
    for spec in specs:
        layer.read(spark, spec).createOrReplaceTempView(f"{prefix}{spec.name}")


def prefix_conditions(column: str, marks: Sequence[str] = "123456789abcdef") -> list[str]:
    """Disjoint WHERE conditions on a text key that cover every value, NULL included.

    The default marks split hexadecimal ids into sixteen even reading tasks.
    """
    first = f"{column} < '{marks[0]}' OR {column} IS NULL"
    middle = [f"{column} >= '{a}' AND {column} < '{b}'" for a, b in zip(marks, marks[1:])]
    return [first, *middle, f"{column} >= '{marks[-1]}'"]


def unpad(df: DataFrame, spec: TableSpec) -> DataFrame:
    """CHAR columns without the blanks that fill them up to their width."""
    padded = [c.name for c in spec.columns if c.sql_type.startswith("CHAR(")]
    return df.withColumns({name: F.rtrim(df[name]) for name in padded})


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The declared columns in declared order and type."""
    return df.select(*[df[c.name].cast(c.type).alias(c.name) for c in spec.columns])
