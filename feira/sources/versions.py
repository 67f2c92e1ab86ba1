"""A layer whose tables change together."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.sources.files import delete, move_new, names, read_text, write_text
from feira.sources.layers import ParquetLayer, conform
from feira.sources.scratch import keep
from feira.specs import TableSpec

_VERSIONS, _SUFFIX = "_versions", ".json"


class Outdated(RuntimeError):
    """Another writer was faster; nothing of this one is seen."""


@dataclass(frozen=True)
class VersionedLayer:
    """Parquet files under `root`, and numbered versions that say which of them each table consists of.

    Readers take the newest version. What is written inside a `change` is seen all at once when the block ends,
    or never: the version is a small file that is renamed to the next number last. Outside a block every write
    is a change of its own. A table that is appended to keeps its files; an upsert writes only
    those anew that hold a changed key. Files of earlier versions stay until `clean_up`.
    """

    root: str

    def _folder(self) -> str:
        return f"{self.root.rstrip('/')}/{_VERSIONS}"

    def latest(self, spark: SparkSession) -> tuple[int, dict[str, list[str]]]:
        """Number of the newest version, and the files and folders of each table; 0 before the first."""
        found = [n for n in names(spark, self._folder()) if n.endswith(_SUFFIX)]
        if not found:
            return 0, {}
        return int(found[-1].removesuffix(_SUFFIX)), json.loads(read_text(spark, f"{self._folder()}/{found[-1]}"))

    def find(self, spark: SparkSession, spec: TableSpec) -> DataFrame | None:
        return _Change(self, *self.latest(spark)).find(spark, spec)

    def read(self, spark: SparkSession, spec: TableSpec) -> DataFrame:
        df = self.find(spark, spec)
        if df is None:
            raise FileNotFoundError(f"no table {spec.name} in {self.root}")
        return df

    def write(self, df: DataFrame, spec: TableSpec, mode: str = "overwrite") -> None:
        with self.change(df.sparkSession) as change:
            change.write(df, spec, mode)

    def upsert(self, df: DataFrame, spec: TableSpec) -> list[str]:
        with self.change(df.sparkSession) as change:
            return change.upsert(df, spec)

    @contextmanager
    def change(self, spark: SparkSession) -> Iterator[_Change]:
        """A layer to write to; what it holds becomes the next version unless the block fails."""
        change = _Change(self, *self.latest(spark))
        try:
            yield change
            change.commit(spark)
        except BaseException:
            for path in change.written:
                delete(spark, f"{self.root.rstrip('/')}/{path}")
            raise

    def clean_up(self, spark: SparkSession) -> None:
        """Delete all that the newest version does not need. No change may be under way, no old version be read."""
        number, tables = self.latest(spark)
        needed = {path for paths in tables.values() for path in paths}
        for folder in names(spark, self.root):
            if folder == _VERSIONS or folder in needed:
                continue
            for file in names(spark, f"{self.root.rstrip('/')}/{folder}", "part-"):
                if f"{folder}/{file}" not in needed:
                    delete(spark, f"{self.root.rstrip('/')}/{folder}/{file}")
            if not any(path.startswith(f"{folder}/") for path in needed):
                delete(spark, f"{self.root.rstrip('/')}/{folder}")
        for version in names(spark, self._folder()):
            if version != f"{number:012d}{_SUFFIX}":
                delete(spark, f"{self._folder()}/{version}")


class _Change:
    """The tables of a layer as they will be."""

    def __init__(self, layer: VersionedLayer, number: int, tables: dict[str, list[str]]):
        self.layer, self.number, self.tables = layer, number, dict(tables)
        self.written: list[str] = []

    def _paths(self, name: str) -> list[str]:
        return [f"{self.layer.root.rstrip('/')}/{path}" for path in self.tables.get(name, [])]

    def find(self, spark: SparkSession, spec: TableSpec) -> DataFrame | None:
        if spec.name not in self.tables:
            return None
        return spark.read.schema(spec.schema).parquet(*self._paths(spec.name))

    read = find

    def _stored(self, df: DataFrame, spec: TableSpec) -> str:
        folder = f"{spec.name}-{uuid4().hex}"
        self.written.append(folder)
        ParquetLayer.placed(conform(df, spec), spec).write.parquet(f"{self.layer.root.rstrip('/')}/{folder}")
        return folder

    def write(self, df: DataFrame, spec: TableSpec, mode: str = "overwrite") -> None:
        before = self.tables.get(spec.name, []) if mode == "append" else []
        self.tables[spec.name] = [*before, self._stored(df, spec)]

    def upsert(self, df: DataFrame, spec: TableSpec) -> list[str]:
        """As `ParquetLayer.upsert`; the files replaced stay for readers of the version before."""
        spark, key = df.sparkSession, list(spec.primary_key)
        new = keep(conform(df, spec), f"upsert-{spec.name}")
        held = self.find(spark, spec)
        if held is None:
            self.write(new, spec)
            return []
        keys, file = new.select(*key), F.col("_metadata.file_path")
        old = [r[0] for r in held.select(*key, file.alias("file")).join(keys, key, "left_semi").select("file").distinct().collect()]
        replaced = {"/".join(path.split("/")[-2:]) for path in old}
        rows = new
        if old:
            rest = spark.read.schema(spec.schema).parquet(*old).join(keys, key, "left_anti")
            rows = rest.select(*spec.names).unionByName(new)
        kept = []
        for path in self.tables[spec.name]:
            inside = [f"{path}/{n}" for n in names(spark, f"{self.layer.root.rstrip('/')}/{path}", "part-")] if "/" not in path else [path]
            kept += [path] if not replaced.intersection(inside) else [f for f in inside if f not in replaced]
        self.tables[spec.name] = [*kept, self._stored(rows, spec)]
        return old

    def commit(self, spark: SparkSession) -> None:
        folder = self.layer._folder()
        draft = f"{folder}/.draft-{uuid4().hex}"
        write_text(spark, draft, json.dumps(self.tables))
        if not move_new(spark, draft, f"{folder}/{self.number + 1:012d}{_SUFFIX}"):
            delete(spark, draft)
            raise Outdated(f"version {self.number + 1} of {self.layer.root} is there already")
