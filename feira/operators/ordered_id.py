"""Ids in sort order that stay in it as rows are added.

Ids have gaps. A new row takes its id from the gap between its neighbours; where a gap has no room, the rows
of the smallest surrounding block of ids that is at most half full are spread over the block anew. All
other rows keep their ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.operators.dense_id import with_dense_id
from feira.sources.scratch import keep

# Ids lie so far apart at first, and the smallest block holds so many of them.
GAP = 1 << 10
BLOCK = 1 << 4


def first_ids(df: DataFrame, order_by: Sequence[str], id_name: str, gap: int = GAP) -> DataFrame:
    """Ids by `order_by`, which must tell all rows apart, `gap` from one to the next."""
    return with_dense_id(df, order_by, id_name).withColumn(id_name, F.col(id_name) * gap)


def _in_order(present: DataFrame, new: DataFrame, order_by: Sequence[str], id_name: str) -> DataFrame:
    """All rows with `old`, their id so far; new rows also with `low`, `next`, the ids of the nearest present rows (0 and NULL
    where there is none), `i`, their place in that gap, and `m`, the number of new rows in it; and `at`, the place of every row.

    Rows are sorted in ranges, and written once, with what a range knows of their neighbours. A range hands its number of rows
    and its first and last present row to the others: one row per range.
    """
    columns = [c for c in present.columns if c != id_name]
    both = present.select(*columns, F.col(id_name).alias("old")).unionByName(
        new.select(*columns, F.lit(None).cast("long").alias("old"))
    )
    # One write fixes the ranges: their borders come from a sample and may differ if the plan runs again.
    ranged = both.repartitionByRange(*order_by).sortWithinPartitions(*order_by).withColumn("task", F.spark_partition_id())
    rows = Window.partitionBy("task")
    up = rows.orderBy(*order_by)
    here = up.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Backwards, as Spark adds up what follows a row anew for each row.
    ahead = rows.orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen, is_new = F.when(F.col("old").isNotNull(), F.col("place")), F.col("old").isNull()
    placed = keep(
        ranged.withColumn("place", F.row_number().over(up).cast("long"))
        .withColumns({"prev": F.max("old").over(here), "prev_place": F.max(seen).over(here)})
        .withColumns({"next": F.min("old").over(ahead), "next_place": F.min(seen).over(ahead)})
        # Present rows need no neighbours, and NULLs take no room.
        .withColumns({c: F.when(is_new, F.col(c)) for c in ("prev", "prev_place", "next", "next_place")}),
        "ordered-rows",
    )
    tasks = Window.orderBy("task")
    earlier = tasks.rowsBetween(Window.unboundedPreceding, -1)
    later = tasks.rowsBetween(1, Window.unboundedFollowing)
    sums = placed.groupBy("task").agg(
        F.count("*").alias("n"),
        F.min("old").alias("low_id"),
        F.max("old").alias("high_id"),
        F.min(seen).alias("low_place"),
        F.max(seen).alias("high_place"),
    )
    before = F.col("before")
    ranges = sums.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select(
        "task",
        "before",
        F.max("high_id").over(earlier).alias("last"),
        F.max(before + F.col("high_place")).over(earlier).alias("last_at"),
        F.min("low_id").over(later).alias("following"),
        F.min(before + F.col("low_place")).over(later).alias("following_at"),
    )
    low_at = F.coalesce(before + F.col("prev_place"), "last_at", F.lit(0))
    next_at = F.coalesce(before + F.col("next_place"), "following_at")
    at = before + F.col("place")
    return placed.join(F.broadcast(ranges), "task").select(
        *columns,
        "old",
        at.alias("at"),
        F.when(is_new, F.coalesce("prev", "last", F.lit(0))).alias("low"),
        F.when(is_new, F.coalesce("next", "following")).alias("next"),
        F.when(is_new, at - low_at).alias("i"),
        F.when(is_new, next_at - low_at - 1).alias("m"),
    )


def _block(of: Column, size: int) -> Column:
    return F.floor(of / F.lit(size)).cast("long")


def _block_sums(rows: DataFrame, size: int) -> DataFrame:
    """Per smallest block: the number of its `own` rows, and of the new rows `into` it, which lie in front of its first
    present row and behind the last one of block `from_block`, with the first place of each."""
    own, into = _block(F.coalesce("old", "low"), size), _block(F.col("next"), size)
    none = F.lit(None).cast("long")

    def entry(block: Column, own_at: Column, into_at: Column, origin: Column) -> Column:
        return F.struct(block.alias("block"), own_at.alias("own_at"), into_at.alias("into_at"), origin.alias("origin"))

    at = F.col("at")
    crossing = F.when(F.col("old").isNull() & (into != own), entry(into, none, at, own))
    return (
        rows.select(F.inline(F.array(entry(own, at, none, none), crossing)))
        .filter("block IS NOT NULL")
        .groupBy("block")
        .agg(
            F.count("own_at").alias("own"),
            F.count("into_at").alias("into"),
            F.min("own_at").alias("own_at"),
            F.min("into_at").alias("into_at"),
            F.max("origin").alias("from_block"),
        )
    )


def _settled(sums: DataFrame, full: DataFrame, size: int) -> list[tuple[int, DataFrame]]:
    """(ratio, blocks) from small to large: the blocks around full gaps that are at most half full, with the number `c` of
    their rows and the `first` place. `ratio` smallest blocks make one.

    Rows that lie in front of a block are counted in, as they may have to move into it.
    """
    found, ratio, blocks = [], 1, full
    while True:
        block = _block(F.col("block"), ratio)
        crosses = _block(F.col("from_block"), ratio) != block
        counts = sums.groupBy(block.alias("block")).agg(
            F.sum(F.col("own") + F.when(crosses, F.col("into")).otherwise(0)).alias("c"),
            F.min(F.least("own_at", F.when(crosses, F.col("into_at")))).alias("first"),
        )
        measured = keep(blocks.join(counts, "block"), "id-blocks")
        found.append((ratio, measured.filter(F.col("c") * 2 <= size * ratio)))
        blocks = measured.filter(F.col("c") * 2 > size * ratio).select(_block(F.col("block"), 2).alias("block")).distinct()
        if blocks.isEmpty():
            return found
        ratio *= 2


def _targets(rows: DataFrame, full: DataFrame, size: int) -> DataFrame:
    """(block, own_to, next_to) per smallest block with rows to move: the block that its rows are spread over, the
    largest one around it; and the one that rows behind its last present row may go to, which is around the next row.
    """
    sums = keep(_block_sums(rows, size), "id-block-sums")
    marked, marks = sums, []
    for ratio, blocks in _settled(sums, full, size):
        to = F.struct(
            F.lit(size * ratio).cast("long").alias("size"), F.col("block").alias("block"), F.col("c").alias("c"), F.col("first").alias("first")
        )
        known = blocks.select(F.col("block").alias("around"), to.alias(f"to{ratio}"))
        marked = marked.join(known, _block(F.col("block"), ratio) == F.col("around"), "left").drop("around")
        marks.insert(0, f"to{ratio}")
    moving = keep(marked.select("block", "from_block", F.coalesce(*marks).alias("to")).filter("to IS NOT NULL"), "moving-blocks")
    after = moving.filter("from_block IS NOT NULL").select(F.col("from_block").alias("block"), F.col("to").alias("next_to"))
    return moving.select("block", F.col("to").alias("own_to")).join(after, "block", "full")


def add_ordered(
    present: DataFrame, new: DataFrame, order_by: Sequence[str], id_name: str, gap: int = GAP
) -> DataFrame:
    """The rows of both with ids in the order of `order_by`, and `moved`: true for present rows with another id.

    `present` has positive ids in that order. `order_by` tells all rows of both apart. Rows behind the last one are `gap`
    apart; where many go into one gap they share it evenly.

    Gaps and blocks are settled on sums per block; whole rows are sorted once and joined once, with the blocks to move.
    """
    columns = [c for c in present.columns if c != id_name]
    size = gap * BLOCK
    rows = _in_order(present, new, order_by, id_name)
    fresh = F.when(F.col("next").isNull(), F.col("low") + F.col("i") * gap).otherwise(
        F.col("low") + F.floor(F.col("i") * (F.col("next") - F.col("low")) / (F.col("m") + 1)).cast("long")
    )
    # One row of each gap without room.
    full = keep(rows.filter("i = 1 AND next - low <= m").select(_block(F.col("low"), size).alias("block")).distinct(), "full-gaps")
    own, into = _block(F.coalesce("old", "low"), size), _block(F.col("next"), size)
    crossing = F.col("old").isNull() & (into != own)
    # Few columns, as a join may follow.
    numbered = rows.select(*columns, "old", fresh.alias("fresh"), "at", own.alias("block"), crossing.alias("crossing"))
    id_ = F.coalesce("old", "fresh")
    if not full.isEmpty():
        numbered = numbered.join(_targets(rows, full, size), "block", "left")
        behind = F.when(F.col("crossing"), F.col("next_to"))
        # The larger block; of equal ones the block a row is in before the one it is in front of.
        to = F.when(behind["size"] > F.col("own_to.size"), behind).otherwise(F.coalesce("own_to", behind))
        numbered = numbered.withColumn("to", to)
        step = F.floor((F.col("at") - F.col("to.first") + 1) * F.col("to.size") / (F.col("to.c") + 1)).cast("long")
        id_ = F.when(F.col("to").isNotNull(), F.col("to.size") * F.col("to.block") + step).otherwise(id_)
    moved = F.coalesce(F.col("old") != id_, F.lit(False)).alias("moved")
    return numbered.select(id_.alias(id_name), *columns, moved)
