"""CSV files whose quoted fields hold line breaks, read in splits.

Whether a line of text begins a record depends on the quotes of all lines before it in the file. Each split
is first summed up as a function from "begins outside quotes" and "begins inside quotes" to the state it ends
in; these functions, one row per split, are chained over the file. Then every split knows how it begins, and its
lines are joined to records where they are. Only records that cross a border between splits meet elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feira.sources.scratch import keep

# States within a line: at the start of a field, within a plain field, within quotes, and
# right behind a quote within quotes, which the next quote would make a doubled one.
FIELD, PLAIN, QUOTED, BEHIND = range(4)


def _ends_inside(parts: Column, state: Column) -> Column:
    """Whether a line, cut at its quotes, ends inside quotes when its first quote is met in `state`.

    A quote opens a field only at its start; elsewhere outside quotes it is a letter like others. A quote
    that closes a field may be followed by more text, up to the next comma.
    """

    def after(now: Column, part: Column) -> Column:
        return (
            F.when(now.isin(FIELD, BEHIND), QUOTED)
            .when((now == QUOTED) & (part == ""), BEHIND)
            .when(F.endswith(part, F.lit(",")), FIELD)
            .otherwise(PLAIN)
        )

    rest = F.slice(parts, F.lit(2), F.size(parts))
    return F.aggregate(rest, state.cast("int"), after, lambda now: now == QUOTED)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, id, value, quotes, out, inside): the lines of each split in the order of `id`.

    `out` is the state a line ends in, 1 inside quotes, when it begins outside; `inside` when it begins inside.
    """
    parts = F.split("value", '"', -1)
    first = F.when((parts[0] == "") | F.endswith(parts[0], F.lit(",")), FIELD).otherwise(PLAIN)
    quotes = F.contains("value", F.lit('"'))
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("id"),
            "value",
            quotes.alias("quotes"),
            F.when(quotes, _ends_inside(parts, first)).otherwise(False).cast("int").alias("out"),
            F.when(quotes, _ends_inside(parts, F.lit(QUOTED))).otherwise(True).cast("int").alias("inside"),
        )
    )


def _through(state: Column, step: Column) -> Column:
    return F.when(state == 1, step["inside"]).otherwise(step["out"])


def split_states(text: DataFrame) -> DataFrame:
    """(file, block, carry, crlf): the state each split begins in, 1 inside quotes, and how lines of its file end."""
    step = F.struct("id", "out", "inside")
    per_split = (
        text.groupBy("file", "block")
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("quotes"), step))).alias("steps"),
            F.endswith(F.min_by("value", "id"), F.lit("\r")).alias("crlf"),
        )
        .select("file", "block", "crlf", *[
            F.aggregate("steps", F.lit(state), _through).alias(name) for state, name in ((0, "out"), (1, "inside"))
        ])
    )
    splits = F.sort_array(F.collect_list(F.struct("block", "out", "inside", "crlf")))
    states = F.aggregate(
        "splits",
        F.array(F.lit(0)),
        lambda so_far, step: F.concat(so_far, F.array(_through(F.element_at(so_far, -1), step))),
    )
    each = F.inline(F.arrays_zip(F.col("splits.block").alias("block"), F.col("states").alias("carry")))
    files = per_split.groupBy("file").agg(splits.alias("splits"))
    chained = files.select("file", "splits", states.alias("states"), F.col("splits.crlf")[0].alias("crlf"))
    return chained.select("file", "crlf", each).filter("block IS NOT NULL")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(record): the records of all files of `path` but their first ones, the headers.

    Empty lines between records are left out. Where the header ends with a carriage return and a line
    feed, these two are one line feed everywhere; else line breaks within quotes stay as they are.
    """
    text = lines(spark, path)
    known = keep(split_states(text), "split-states")
    split = Window.partitionBy("file", "block").orderBy("id")
    # A line leaves the state as it is, turns it, or sets it whatever it was.
    turns = (F.col("out") == 1) & (F.col("inside") == 0)
    sets = F.when(F.col("out") == F.col("inside"), F.col("out"))
    turned = text.join(known, ["file", "block"]).select(
        "file", "block", "crlf", "id", "value", "carry", sets.alias("set"), F.sum(turns.cast("int")).over(split).alias("turns")
    )
    last_set = F.last((F.col("set") + F.col("turns")) % 2, ignorenulls=True).over(split)
    after = turned.withColumn("after", (F.coalesce(last_set, "carry") + F.col("turns")) % 2)
    begins = F.coalesce(F.lag("after").over(split), "carry") == 0
    marked = after.select(
        "file", "block", "crlf", "id", "value", "after", begins.alias("begins"), F.row_number().over(split).alias("place")
    ).select(
        "file",
        "block",
        "crlf",
        F.last(F.when(F.col("begins"), F.col("id")), ignorenulls=True).over(split).alias("start"),
        ((F.col("block") == 0) & (F.col("place") == 1)).alias("header"),
        F.struct("id", "value", "after").alias("line"),
    )
    # Partitioned as the windows are.
    pieces = marked.groupBy("file", "block", "start").agg(
        F.sort_array(F.collect_list("line")).alias("lines"),
        F.max("header").alias("header"),
        F.first("crlf").alias("crlf"),
    )
    pieces = pieces.select(
        "file",
        "block",
        "start",
        "header",
        "crlf",
        F.array_join("lines.value", "\n").alias("piece"),
        (F.element_at("lines", -1)["after"] == 1).alias("goes_on"),
    )
    pieces = keep(pieces, "record-pieces")
    whole = F.col("start").isNotNull() & ~F.col("goes_on")
    # Two pieces a split at most, the first before the last.
    in_file = Window.partitionBy("file").orderBy("block", F.asc_nulls_first("start"))
    begun = F.last(F.when(F.col("start").isNotNull(), F.struct("block", "start")), ignorenulls=True).over(in_file)
    place = F.struct("block", F.col("start").isNotNull().alias("own"), "piece")
    crossing = (
        pieces.filter(~whole)
        .withColumn("begun", begun)
        .groupBy("file", "begun")
        .agg(
            F.sort_array(F.collect_list(place)).alias("all"),
            F.max("header").alias("header"),
            F.first("crlf").alias("crlf"),
        )
        .select("header", "crlf", F.array_join("all.piece", "\n").alias("piece"))
    )
    both = pieces.filter(whole).select("header", "crlf", "piece").unionByName(crossing)
    plain = F.replace(F.regexp_replace("piece", "\\r\\z", ""), F.lit("\r\n"), F.lit("\n"))
    record = F.when(F.col("crlf"), plain).otherwise(F.col("piece")).alias("record")
    return both.filter(~F.col("header")).select(record).filter("record <> ''")
