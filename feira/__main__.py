"""Command line: ``spark-submit`` this package's steps on folders of files."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from feira.plans.refresh import LOADED, Layers, load_clean, load_marts, load_raw
from feira.session import configured

STEPS = ("raw", "clean", "marts")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="feira", description="Raw files to raw tables, clean tables, marts.")
    parser.add_argument("source", help="folder of the raw files")
    parser.add_argument("target", help="folder for the layers raw, clean and marts")
    parser.add_argument("--steps", nargs="+", choices=STEPS, default=STEPS)
    parser.add_argument("--on-violation", choices=("fail", "report", "quarantine"), default="fail")
    parser.add_argument("--quote-escape", default='"', help="what stands before a quote inside a field")
    chosen = parser.parse_args(arguments)

    spark = configured(SparkSession.builder.appName("feira")).getOrCreate()
    layers = Layers.parquet(chosen.target)
    if "raw" in chosen.steps:
        load_raw(spark, chosen.source, layers.raw, chosen.quote_escape)
    if "clean" in chosen.steps:
        load_clean(spark, layers, chosen.on_violation, loaded=layers.raw.read(spark, LOADED))
    if "marts" in chosen.steps:
        load_marts(spark, layers)


if __name__ == "__main__":
    main()
