"""Folders of any file system Spark can write to."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path for it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _open(spark, path)
    return system.exists(at)


def names(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """What lies in a folder and begins with `prefix`, by name; nothing if the folder does not exist."""
    system, at = _open(spark, path)
    if not system.exists(at):
        return []
    return sorted(n for n in (f.getPath().getName() for f in system.listStatus(at)) if n.startswith(prefix))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, there in full or not at all: it is written under another name first."""
    system, at = _open(spark, path)
    new = _open(spark, f"{path}.new")[1]
    out = system.create(new, True)
    out.write(bytearray(text.encode()))
    out.close()
    system.delete(at, False)
    if not system.rename(new, at):
        raise OSError(f"{new} cannot be renamed to {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file, or None if it does not exist."""
    system, at = _open(spark, path)
    if not system.exists(at):
        return None
    source = system.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def make_folder(spark: SparkSession, path: str) -> None:
    system, at = _open(spark, path)
    system.mkdirs(at)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file, unless that was done before."""
    system, at = _open(spark, path)
    if system.exists(at) and not system.rename(at, _open(spark, target)[1]):
        raise OSError(f"{path} cannot be renamed to {target}")


def move_new(spark: SparkSession, path: str, target: str) -> bool:
    """Rename a file to a name that is free; False if it is taken."""
    system, at = _open(spark, path)
    goal = _open(spark, target)[1]
    return not system.exists(goal) and system.rename(at, goal)


def delete(spark: SparkSession, path: str) -> None:
    """The folder and all in it; nothing if it does not exist."""
    system, at = _open(spark, path)
    system.delete(at, True)


def replace(spark: SparkSession, new: str, path: str) -> None:
    """Put the finished folder `new` in the place of `path`.

    The old folder is renamed first and deleted last, so at every moment one of the two is whole. On
    file systems that copy to rename, such as object stores, this moves the data once more.
    """
    system, target = _open(spark, path)
    old = _open(spark, f"{new}-old")[1]
    system.mkdirs(target.getParent())
    had = system.exists(target) and system.rename(target, old)
    if not system.rename(_open(spark, new)[1], target):
        if had:
            system.rename(old, target)
        raise OSError(f"{new} cannot be renamed to {path}")
    if had:
        system.delete(old, True)
