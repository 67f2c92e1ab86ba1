"""Shared pieces of the operators: tables, words, columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.sources.scratch import keep

# What separates words (space, tab to carriage return), as a Java pattern.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """`keep`, after which Spark deletes the shuffle files of the job: nothing reads them again."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        return keep(df, label, spark.conf.get("spark.sql.parquet.compression.codec"))
    finally:
        spark.conf.set(CLEANUP, before)


def words(text: Column) -> Column:
    """The words of a text in order; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def word_count(text: Column) -> Column:
    """Number of words as a long, without building them."""
    whole = F.coalesce(text, F.lit(""))
    return F.regexp_count(whole, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def with_results(df: DataFrame, results: dict[str, Column]) -> DataFrame:
    """`df` with the result columns last; a result replaces an input column of its name."""
    taken = {name.lower() for name in results}
    others = [F.col(f"`{name}`") for name in df.columns if name.lower() not in taken]
    return df.select(*others, *[column.alias(name) for name, column in results.items()])
