"""What an append to several tables has done so far, so that a second run can finish or undo it."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from feira.sources.files import delete, names, read_text, write_text

FILE = "_append"


def fingerprint(spark: SparkSession, folders: Iterable[str]) -> str:
    """Changes whenever a table in one of the folders is written: Spark gives every file a name of its own."""
    found = [(folder, names(spark, folder, "part-")) for folder in sorted(folders)]
    return hashlib.sha256(json.dumps(found).encode()).hexdigest()


@dataclass
class AppendLedger:
    """A small file in the folder of the tables, there while an append is under way.

    `before` holds the files each table had, `done` the tables that have their new rows.
    """

    root: str
    run: str
    before: dict[str, list[str]] = field(default_factory=dict)
    done: list[str] = field(default_factory=list)

    @staticmethod
    def _path(root: str) -> str:
        return f"{root.rstrip('/')}/{FILE}"

    @classmethod
    def open(cls, spark: SparkSession, root: str, run: str, tables: Iterable[str]) -> AppendLedger:
        """The ledger of this run, or a new one.

        What a run with the same input has finished stays; the files of a table it was writing go. Of
        a run with other input nothing stays, unless it had finished every table.
        """
        text, tables = read_text(spark, cls._path(root)), list(tables)
        if text is not None:
            old = cls(root, **json.loads(text))
            if set(old.done) != set(old.before):
                same = old.run == run
                for table in old.before:
                    if not (same and table in old.done):
                        old._undo(spark, table)
                if same:
                    return old
        ledger = cls(root, run, {t: names(spark, f"{root.rstrip('/')}/{t}", "part-") for t in tables})
        ledger._save(spark)
        return ledger

    def _undo(self, spark: SparkSession, table: str) -> None:
        folder = f"{self.root.rstrip('/')}/{table}"
        for name in names(spark, folder):
            if name not in self.before[table] and name != "_SUCCESS":
                delete(spark, f"{folder}/{name}")

    def _save(self, spark: SparkSession) -> None:
        state = {"run": self.run, "before": self.before, "done": self.done}
        write_text(spark, self._path(self.root), json.dumps(state))

    def finish(self, spark: SparkSession, tables: Iterable[str]) -> None:
        self.done += [table for table in tables if table not in self.done]
        self._save(spark)

    def close(self, spark: SparkSession) -> None:
        delete(spark, self._path(self.root))
