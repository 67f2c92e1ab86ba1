"""Mixing sources to target weights by entropy balancing, with built-in functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.tables import stored, word_count

# No source and no document is taken more than this many times.
MOST = 3
WEIGHTS = (1, 2, 3)
SEED = 60_013
STEPS = 60
CLOSE = 1e-7
BINS = 1024

EXACT = "decimal(38,12)"


def _sum(value: Column) -> Column:
    """A sum of doubles that does not depend on the order of the rows."""
    return F.sum(value.cast(EXACT)).cast("double")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """(s, source, documents, source_size, target) per source of a (source, size) table.

    Sources by code point, NULL last, take the weights in turn. Targets share the sum of all sizes by
    weight and stop at `most` times the size of the source; what is above goes to the others by
    weight. In order of size per weight the sources that stop come first, so running sums find them.
    The windows hold one row per source.
    """
    per_source = sizes.groupBy("source").agg(
        F.count("*").alias("documents"),
        F.sum("size").cast("long").alias("source_size"),
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = per_source.withColumn("s", F.row_number().over(by_name))
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("s") - 1) % len(weights) + 1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_room = Window.orderBy("room", "s").rowsBetween(Window.unboundedPreceding, -1)
    full = F.col("source_size") * most
    weighed = ranked.withColumn("weight", turn.cast("long")).withColumn(
        "room", full / F.col("weight")
    )
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum(full).over(by_room), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_room), F.lit(0)))
    stopped = weighed.withColumn("stops", F.col("room") < level)
    rest = F.sum("source_size").over(everything) - F.sum(
        F.when(F.col("stops"), full).otherwise(0)
    ).over(everything)
    open_weight = F.sum(F.when(~F.col("stops"), F.col("weight")).otherwise(0)).over(everything)
    shared = F.col("weight") * rest / open_weight
    return stopped.select(
        "s",
        "source",
        "documents",
        "source_size",
        F.when(F.col("stops"), full.cast("double")).otherwise(shared).cast("double").alias("target"),
    )


def _rate(size: Column, most: int = MOST) -> Column:
    """exp(tilt * size / scale), at most `most`."""
    return F.least(F.lit(float(most)), F.exp(F.col("tilt") * size / F.col("scale")))


def tilts(hist: DataFrame, targets: DataFrame, most: int = MOST, steps: int = STEPS) -> DataFrame:
    """(s, tilt, scale, want): the solution of the convex dual, one variable per source.

    Of all rates between 0 and `most` that meet the token targets, exp(tilt * size) is closest in
    entropy to taking each document once. A step sums gradient and curvature of the dual over all
    (source, size) groups; a Newton step that leaves the bracket is replaced by its middle. Each state
    is a written table of one row per source, which also cuts the lineage. Sums are exact decimals, so
    a second run gives the same tilts.
    """
    span = hist.filter("size > 0").groupBy("s").agg(F.min("size").alias("least"))
    top = math.log(most)
    state = targets.join(span, "s").select(
        "s",
        (F.col("source_size") / F.col("documents")).alias("scale"),
        F.col("target").alias("want"),
        F.lit(0.0).alias("tilt"),
        F.lit(-1e6).alias("low"),
        (F.lit(1.001 * top) * F.col("source_size") / F.col("documents") / F.col("least")).alias("high"),
        F.lit(1.0).alias("gap"),
    )
    state = stored(state.coalesce(1), "tilts")
    for _ in range(steps):
        if state.agg(F.coalesce(F.max("gap"), F.lit(0.0))).first()[0] <= CLOSE:
            break
        tokens = F.col("count") * F.col("size")
        bent = F.col("tilt") * F.col("size") / F.col("scale") < top
        rate = _rate(F.col("size"), most)
        summed = (
            hist.join(state, "s")
            .groupBy("s", "scale", "want", "tilt", "low", "high")
            .agg(
                _sum(tokens * rate).alias("got"),
                _sum(F.when(bent, tokens * F.col("size") / F.col("scale") * rate).otherwise(0.0)).alias("slope"),
            )
        )
        over = F.col("got") > F.col("want")
        low = F.when(over, F.col("low")).otherwise(F.col("tilt"))
        high = F.when(over, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - (F.col("got") - F.col("want")) / F.nullif(F.col("slope"), F.lit(0.0))
        inside = (newton > low) & (newton < high)
        gap = F.when(F.col("want") > 0, F.abs(F.col("got") / F.col("want") - 1)).otherwise(0.0)
        # From afar, doubling the tilt reaches the bracket's scale sooner than its middle.
        middle = F.when(low < -1e5, F.least(F.lit(-1.0), F.col("tilt") * 4)).otherwise((low + high) / 2)
        moved = F.when(gap <= CLOSE, F.col("tilt")).when(inside, newton).otherwise(middle)
        state = stored(
            summed.select("s", "scale", "want", moved.alias("tilt"), low.alias("low"), high.alias("high"), gap.alias("gap")).coalesce(1),
            "tilts",
        )
    return state.select("s", "tilt", "scale", "want")


def _uniform(seed: int, *columns: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11).cast("double") / float(1 << 53)


def _rounded(sized: DataFrame, seed: int, most: int) -> DataFrame:
    """Adds the whole part of the rate, the part left over, and where the document stands in line."""
    rate = F.when(F.col("want") >= F.col("source_size") * float(most), float(most)).otherwise(
        _rate(F.col("size"), most)
    )
    part = F.col("rate") - F.col("whole")
    ahead = _uniform(seed, F.col("id"), F.col("size")) - F.col("part")
    return (
        sized.withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(1.0))
        .withColumn("whole", F.floor("rate"))
        .withColumn("part", part)
        .withColumn("kind", F.when(F.col("size") > 0, F.floor(F.log2("size"))).otherwise(-1).cast("int"))
        .withColumn("bin", F.floor((ahead + 1) * (BINS // 2)).cast("int"))
    )


def limits(rounded: DataFrame, targets: DataFrame) -> DataFrame:
    """(s, kind, limit): documents of a kind up to this bin get one copy more.

    Kinds are powers of two of the size, the longest first. Each kind takes bins while that brings the
    source closer to its target, and hands what is missing or too much to the next; so what remains at
    the end is about one bin of the shortest documents. Per source there are at most 63 kinds of
    `BINS` bins, whatever the number of documents.
    """
    bins = (
        rounded.filter("part > 0")
        .groupBy("s", "kind", "bin")
        .agg(F.sum("size").alias("tokens"), _sum(F.col("part") * F.col("size")).alias("need"))
    )
    line = Window.partitionBy("s", "kind").orderBy("bin")
    kinds = (
        bins.withColumn("until", F.sum("tokens").over(line))
        .groupBy("s", "kind")
        .agg(
            _sum(F.col("need")).alias("need"),
            F.sort_array(F.collect_list(F.struct("bin", "tokens", "until"))).alias("bins"),
        )
    )
    ordered = kinds.groupBy("s").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("kind")).alias("last"), "need", "bins"))).alias("kinds")
    )
    start = F.struct(
        F.lit(0.0).alias("left"),
        F.array().cast("array<struct<kind:int,limit:int>>").alias("chosen"),
    )

    def step(state: Column, kind: Column) -> Column:
        room = state["left"] + kind["need"]
        taken = F.filter(kind["bins"], lambda b: b["until"] - b["tokens"] / 2 <= room)
        used = F.coalesce(F.array_max(F.transform(taken, lambda b: b["until"])), F.lit(0))
        limit = F.coalesce(F.array_max(F.transform(taken, lambda b: b["bin"])), F.lit(-1))
        chosen = F.struct((-kind["last"]).cast("int").alias("kind"), limit.cast("int").alias("limit"))
        return F.struct(
            (room - used).cast("double").alias("left"),
            F.concat(state["chosen"], F.array(chosen)).alias("chosen"),
        )

    folded = ordered.select("s", F.aggregate("kinds", start, step)["chosen"].alias("chosen"))
    return folded.select("s", F.inline("chosen"))


def mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """`docs` with size, source_size, target, rate, copies and taken (copies * size, as words).

    A result replaces an input column of its name. NULL is a source like any other, the last one. A NULL
    or empty text has size 0 and is taken once: it does not change the mix. Repeated rows are documents of their own with
    equal luck. A table without rows gives an empty table. The documents are joined with tables of a
    few rows per source only; texts are not shuffled.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    sized = docs.select(
        row,
        F.col(f"`{key}`").alias("id"),
        F.col(f"`{source}`").alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"),
    )
    sizes = stored(sized.select("id", "source", "size"), "sizes")
    targets = stored(source_targets(sizes, weights, most).coalesce(1), "targets")

    def with_source(frame: DataFrame, table: DataFrame) -> DataFrame:
        known = table.withColumnRenamed("source", "same_source")
        return frame.join(known, frame["source"].eqNullSafe(known["same_source"])).drop("same_source")

    hist = with_source(sizes.groupBy("source", "size").count(), targets.select("s", "source"))
    hist = stored(hist.select("s", "size", "count"), "size-counts")
    tilt = tilts(hist.filter("size > 0"), targets.filter("target > 0"), most)
    sources = stored(targets.join(tilt, "s", "left").coalesce(1), "sources")
    rounded = _rounded(with_source(sizes, sources), seed, most)
    limit = stored(limits(rounded, targets).coalesce(1), "limits")
    found = _rounded(with_source(sized, sources), seed, most).join(limit, ["s", "kind"], "left")
    extra = (F.col("part") > 0) & (F.col("bin") <= F.coalesce(F.col("limit"), F.lit(-1)))
    copies = (F.col("whole") + F.when(extra, 1).otherwise(0)).cast("long")
    results = {
        "size": F.col("size"),
        "source_size": F.col("source_size"),
        "target": F.col("target"),
        "rate": F.col("rate"),
        "copies": copies,
        "taken": copies * F.col("size"),
    }
    taken = {name.lower() for name in results}
    rest = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in taken]
    return found.select(*rest, *[column.alias(name) for name, column in results.items()])


def expanded(docs: DataFrame, **options) -> DataFrame:
    """Each document as many times as the mix takes it, with the columns of `docs`."""
    renamed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *[
        F.col(f"`{options.get(name, default)}`").alias(alias)
        for name, default, alias in (("key", "doc_id", "k"), ("text", "text", "t"), ("source", "source", "o"))
    ])
    rest = {name: value for name, value in options.items() if name not in ("key", "text", "source")}
    chosen = mixed(renamed, key="k", text="t", source="o", **rest)
    copies = chosen.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return copies.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
