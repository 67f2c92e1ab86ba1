"""Gap-free ids in sort order without sorting on one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feira.sources.scratch import keep

# monotonically_increasing_id() holds the task number above bit 33 and the row number below.
TASK_SHIFT = 33


def with_dense_id(
    df: DataFrame,
    order_by: Sequence[str],
    id_name: str,
    partitions: int | None = None,
    after: int = 0,
) -> DataFrame:
    """Ids `after` + 1 and so on by `order_by`, which must tell all rows apart.

    Rows are range-partitioned and sorted inside each range, then written with their range and
    position. The written copy fixes both: range borders come from a sample and may differ if the
    plan runs again. Offsets are one row per range, so broadcasting them is bounded by the number
    of shuffle partitions.
    """
    ranges = (partitions, *order_by) if partitions else tuple(order_by)
    placed = keep(
        df.repartitionByRange(*ranges)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id()),
        id_name,
    )
    task = F.shiftright("_place", TASK_SHIFT).alias("_task")
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(task)
        .agg(F.count("*").alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << TASK_SHIFT) - 1))
    return (
        placed.withColumn("_task", task)
        .join(F.broadcast(offsets), "_task")
        .select((F.col("_offset") + position + 1 + after).alias(id_name), *df.columns)
    )


def numbered_geolocation(geolocation: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """Distinct locations with `geolocation_id` by place name, then coordinates.

    Locations that are `present` are left out, and ids go on after the largest one there.
    """
    # The sort key of the location table.
    order = (
        "geolocation_zip_code_prefix",
        "geolocation_city",
        "geolocation_state",
        "geolocation_lat",
        "geolocation_lng",
    )
    if present is None:
        return with_dense_id(geolocation.dropDuplicates(), order, "geolocation_id")
    new = geolocation.subtract(present.select(*geolocation.columns))
    last = present.agg(F.max("geolocation_id")).first()[0] or 0
    return with_dense_id(new, order, "geolocation_id", after=last)
