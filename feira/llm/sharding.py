"""Two-pass external shuffle into shards of equal row counts, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.tables import stored

SHARDS = 16
SEED = 20_011
# Buckets grow with the table from the first size, which keeps their number near the last one, up to the second.
BUCKET_BYTES = 16 << 20
MOST_BUCKET_BYTES = 256 << 20
BUCKETS = 4096
# Rows of a bucket are this many bytes long on average at least, so short rows do not crowd into one.
LEAST_BYTES = 16
# Copies of one row are dealt in parts of this part of a bucket.
PART = 8
# Hashes of rows with many copies are broadcast up to this number, and joined by key beyond.
FEW = 1_000_000


def record_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text plus 1; a NULL text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc32(text: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def scatter(row: Column, part: Column, buckets: int, seed: int) -> Column:
    """The bucket of a part of the copies of a row: a seeded hash, uniform whatever the order of the input."""
    return F.pmod(F.xxhash64(F.lit(seed), row, part), F.lit(buckets)).cast("int")


def row_hash(docs: DataFrame, columns: list[str]) -> Column:
    """A hash of the columns, but for those of types without one."""
    kinds = {c: docs.schema[c].dataType.simpleString() for c in columns}
    return F.xxhash64(*[F.col(f"`{c}`") for c in columns if "map<" not in kinds[c] and "variant" not in kinds[c]])


def _exact(docs: DataFrame, name: str) -> Column:
    """A grouping key that is equal only for the same value: -0.0 is not 0.0, nor one case of a letter another."""
    kind = docs.schema[name].dataType.typeName()
    column = F.col(f"`{name}`")
    return column.cast("binary") if kind == "string" else column.cast("string") if kind in ("float", "double") else column


def dealt_rows(docs: DataFrame, text: str, bucket_bytes: int, seed: int) -> tuple[DataFrame, int, int, bool]:
    """(row, record, part, copies, bucket), the numbers of rows and buckets, and whether any row has copies."""
    whole = docs.select(
        row_hash(docs, docs.columns).alias("row"),
        record_bytes(F.col(f"`{text}`")).alias("bytes"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
        *[_exact(docs, c).alias(f"exact {i}") for i, c in enumerate(docs.columns)],
    )
    groups = stored(whole.groupBy("row").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")), "equal-rows")
    size = groups.agg(F.sum("n"), F.sum("bytes")).first()
    rows, total = size[0] or 0, size[1] or 0
    bucket_bytes = max(bucket_bytes, min(MOST_BUCKET_BYTES, total // BUCKETS))
    buckets = max(1, -(-total // bucket_bytes), -(-rows * LEAST_BYTES // bucket_bytes))
    in_part = F.expr(f"greatest(1L, {bucket_bytes}L div ({PART} * greatest(bytes, {LEAST_BYTES}L)))")
    many = groups.withColumn("bytes", F.expr("bytes div n")).filter(F.col("n") > in_part).select("row")
    single = whole.select("row", "record", F.lit(0).alias("part"), F.lit(1).alias("copies"))
    # At most PART rows a bucket. Rows with the same hash that are not equal are grouped apart.
    hashes = many.count()
    repeated = hashes > 0
    if repeated:
        if hashes <= FEW:
            many = F.broadcast(many)
        grouped = (
            whole.join(many, "row", "left_semi")
            .groupBy("row", "bytes", *[f"exact {i}" for i in range(len(docs.columns))])
            .agg(F.count("*").alias("n"), F.first("record").alias("record"))
        )
        parts = stored(grouped.select("row", "record", "n", in_part.alias("m")), "repeated-rows").select(
            "row", "record", "n", "m", F.explode(F.expr("sequence(0, cast((n - 1) div m AS int))")).alias("part")
        )
        copies = F.expr("cast(least(m, n - part * m) AS int)").alias("copies")
        single = single.join(many, "row", "left_anti").unionByName(parts.select("row", "record", "part", copies))
    bucket = scatter(F.col("row"), F.col("part"), buckets, seed)
    return single.withColumn("bucket", bucket), rows, buckets, repeated


def in_shards(
    docs: DataFrame, shards: int, seed: int, bucket_bytes: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` with `shard` and `slot`, as `write_shards` writes them. The records are exchanged once."""
    results = ("shard", "slot")
    kept = [c for c in docs.columns if c.lower() not in results]
    single, rows, buckets, repeated = dealt_rows(docs.select(*[F.col(f"`{c}`") for c in kept]), text, bucket_bytes, seed)

    first = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = single.groupBy("bucket").agg(F.sum("copies").alias("count"))
    # One row per bucket, which travels with its records.
    begins = counts.select(
        "bucket",
        F.lit(None).alias("entry"),
        F.coalesce(F.sum("count").over(first), F.lit(0)).alias("begin"),
    )
    order = F.xxhash64(F.lit(seed + 1), F.col("row"))
    at_key = F.col("record").getField(key)
    dealt = single.select(
        "bucket",
        F.struct(order.alias("order"), at_key.alias("key"), "record", "copies").alias("entry"),
        F.lit(None).cast("long").alias("begin"),
    )
    entries = F.array_sort("entries", lambda a, b: _compare(a, b))
    if repeated:
        entries = F.flatten(F.transform(entries, lambda e: F.array_repeat(e, e["copies"])))
    placed = (
        dealt.unionByName(begins)
        .repartitionById(buckets, F.col("bucket"))
        .groupBy("bucket")
        .agg(F.collect_list("entry").alias("entries"), F.max("begin").alias("begin"))
        .select("begin", F.posexplode(F.shuffle(entries, seed)).alias("place", "entry"))
    )
    at = F.col("begin") + F.col("place")
    shard = F.expr(f"(begin + place) * {shards} div {max(rows, 1)}")
    begin_of_shard = F.expr(f"(shard * {rows} + {shards - 1}) div {shards}")
    return (
        placed.select(*[F.col("entry.record").getField(c).alias(c) for c in kept], at.alias("at"), shard.alias("shard"))
        .withColumn("slot", (F.col("at") - begin_of_shard).cast("long"))
        .withColumn("shard", F.col("shard").cast("int"))
        .drop("at")
    )


def write_shards(
    docs: DataFrame,
    path: str,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Write `docs` in random order to folders `shard=0` ... under `path`; returns the written table.

    Pass one deals the records to buckets of about `bucket_bytes`, more for tables of very many, by a seeded
    hash of all their columns;
    pass two puts each bucket in a random order in one task (Spark's `shuffle` is a Fisher-Yates
    shuffle; its input is sorted first and each bucket has a task of its own, so that a second run
    gives the same order) and writes it. The records of all buckets, one bucket after the other, are
    cut into `shards` runs whose lengths differ by one at most; `slot` counts from 0 in each.

    The result columns `shard` and `slot` replace input columns of those names. Copies of a text have
    keys of their own and so spread over all buckets, as do records without key or text. Rows that are equal in
    all columns and fill more than 1 / PART of a bucket travel as (row, copies), in parts that are dealt
    each by itself and expanded in their buckets. A table without rows gives an empty table.
    """
    table = in_shards(docs, shards, seed, bucket_bytes, key, text)
    table.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(table.schema).parquet(path)


def _compare(a: Column, b: Column) -> Column:
    """By random order, then key; records equal in both may stand either way."""
    return (
        F.when(a["order"] < b["order"], -1)
        .when(a["order"] > b["order"], 1)
        .when(a["key"] < b["key"], -1)
        .when(a["key"] > b["key"], 1)
        .otherwise(0)
    )


def digest(table: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """What the written shards hold, one row per record."""
    whole = F.col(f"`{text}`")
    return table.select(
        F.col(f"`{key}`").alias("doc_id"),
        record_bytes(whole).alias("size"),
        text_crc32(whole).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
