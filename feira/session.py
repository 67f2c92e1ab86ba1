"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE resizes shuffles, turns joins into broadcasts once the real size is known, and splits hot
# join partitions. The forced variant also splits when the split costs one more shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Call sites are kept for every column expression by default, which doubles planning time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # The default keeps 100 compiled stages, fewer than the jobs of one session have.
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def tune(spark: SparkSession) -> None:
    """The settings above on a running session, as far as they can still be changed."""
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)


def configured(builder: SparkSession.Builder, settings: dict[str, str] | None = None) -> SparkSession.Builder:
    """The settings above, and those given, on a session yet to be made."""
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    memory: str = "4g",
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("feira")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    spark = configured(builder, settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
