"""Exact top-k by inner product, block at a time in order of bounds.

Vectors are cut into blocks of neighbouring ids. A block keeps its vectors (its forward index) and, per
term, the largest and the smallest component. The sum over a query's terms of the larger of the two
products bounds every score in the block. Each query takes blocks in order of that bound, in waves that
grow fourfold; after a wave it goes on only with blocks whose bound reaches its k-th best score so far.

Queries and block summaries are packed, some hundred per row, so bounds are computed on matrices. Spark
brings the blocks of a wave together with the queries that want them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.llm.tables import stored

SCALE = 1024
K = 10
BLOCK = 1024
QUERIES = 256
SUMMARIES = 1024
FIRST_WAVE = 4
GROWTH = 4
NONE = -(1 << 63)


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as a long; NULL if the vector or a component is NULL or not finite."""
    real = F.transform(vector, lambda x: x.cast("double"))
    # Infinity less itself is not a number either.
    finite = F.forall(real, lambda x: F.coalesce((x - x) == 0.0, F.lit(False)))
    return F.when(finite, F.transform(real, lambda x: F.floor(x * float(scale))))


def _pack(rows: list[list[int]]) -> tuple[np.ndarray, int]:
    """Vectors as one matrix; missing components of shorter vectors are 0."""
    width = max([len(row) for row in rows])
    return np.array([row + [0] * (width - len(row)) for row in rows], np.int64).reshape(len(rows), width), width


PACKED = "part long, width int, ids array<long>, cells binary, high binary, low binary"


def packed(vectors: DataFrame, size: int) -> DataFrame:
    """Rows (id, v) in order of id, `size` to a row, with the term maxima and minima of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        rows: list[list[int]] = []

        def close() -> pa.RecordBatch:
            cells, width = _pack(rows)
            row = {
                "part": (task << 32) + number,
                "width": width,
                "ids": ids,
                "cells": cells.tobytes(),
                "high": cells.max(axis=0).tobytes() if width else b"",
                "low": cells.min(axis=0).tobytes() if width else b"",
            }
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for key, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(key)
                rows.append(vector)
                if len(ids) == size:
                    yield close()
                    number, ids, rows = number + 1, [], []
        if ids:
            yield close()

    schema = pa.schema(
        [
            ("part", pa.int64()),
            ("width", pa.int32()),
            ("ids", pa.list_(pa.int64())),
            ("cells", pa.binary()),
            ("high", pa.binary()),
            ("low", pa.binary()),
        ]
    )
    ordered = vectors.select("id", "v").repartitionByRange("id", F.xxhash64("v")).sortWithinPartitions("id", "v")
    return ordered.mapInArrow(run, PACKED)


def _matrix(data: bytes, rows: int, width: int) -> np.ndarray:
    return np.frombuffer(data, np.int64).reshape(rows, width)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a times b transposed, exact: in doubles where no sum can exceed 2**53, else in whole numbers of any size."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    top = [max(abs(int(m.min())), abs(int(m.max()))) if m.size else 0 for m in (a, b)]
    if top[0] * top[1] * max(1, width) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    if max([abs(int(x)) for x in exact.ravel()], default=0) >= 1 << 63:
        raise OverflowError("a score does not fit a long")
    return exact.astype(np.int64)


def bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """For each query and block, a number that no score in the block exceeds (as doubles, rounded up)."""
    width = min(queries.shape[1], high.shape[1])
    q = queries[:, :width].astype(np.float64)
    most = np.maximum(q, 0) @ high[:, :width].T.astype(np.float64) + np.minimum(q, 0) @ low[:, :width].T.astype(np.float64)
    # More than the rounding of the sums can be.
    size = np.abs(q) @ np.maximum(np.abs(high[:, :width]), np.abs(low[:, :width])).T.astype(np.float64)
    return most + size * 1e-12


def wanted(chunks: DataFrame, summaries: DataFrame, done: int, wave: int) -> DataFrame:
    """(block, part, rows): the queries of a chunk that take a block in this wave.

    The wave holds the blocks of rank `done` to `done + wave` in a query's order, within each row of
    summaries, as far as the bound reaches the query's k-th score.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                queries = _matrix(row["cells"], len(row["ids"]), row["width"])
                blocks = row["blocks"]
                widest = max([b["width"] for b in blocks])

                def edge(name: str) -> np.ndarray:
                    found = np.zeros((len(blocks), widest), np.int64)
                    for i, b in enumerate(blocks):
                        found[i, : b["width"]] = np.frombuffer(b[name], np.int64)
                    return found

                most = bounds(queries, edge("high"), edge("low"))
                order = np.argsort(-most, axis=1, kind="stable")[:, done : done + wave]
                takes = np.take_along_axis(most, order, 1) >= np.array(row["kth"], np.float64)[:, None]
                for b in np.unique(order[takes]).tolist():
                    rows = np.flatnonzero(((order == b) & takes).any(axis=1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([blocks[b]["block"]], pa.int64()),
                            pa.array([row["part"]], pa.int64()),
                            pa.array([rows.tolist()], pa.list_(pa.int32())),
                        ],
                        ["block", "part", "rows"],
                    )

    # A stated set of queries against all blocks, hundreds of each to a row.
    pairs = chunks.crossJoin(summaries)
    return pairs.mapInArrow(run, "block long, part long, rows array<int>")


def scored(wants: DataFrame, blocks: DataFrame, chunks: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): per block and query the k best that reach the query's k-th score so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                picked = np.array(row["rows"])
                ids = np.array(row["block_ids"], np.int64)
                block = _matrix(row["block_cells"], len(ids), row["block_width"])
                queries = _matrix(row["cells"], len(row["ids"]), row["width"])[picked]
                names = np.array(row["ids"], np.int64)[picked]
                kth = np.array(row["kth"], np.int64)[picked]
                scores = _product(queries, block)
                fit = (scores >= kth[:, None]) & (names[:, None] != ids)
                # Stable: of equal scores the smaller id comes first, as the block is in order of id.
                least = np.where(fit, scores, NONE)
                best = np.argsort(~least, axis=1, kind="stable")[:, :k]
                found = np.take_along_axis(fit, best, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(names, found.sum(axis=1))),
                        pa.array(ids[best][found]),
                        pa.array(np.take_along_axis(scores, best, 1)[found]),
                    ],
                    ["query_id", "vec_id", "score"],
                )

    full = blocks.select(
        F.col("part").alias("block"),
        F.col("width").alias("block_width"),
        F.col("ids").alias("block_ids"),
        F.col("cells").alias("block_cells"),
    )
    return wants.join(full, "block").join(chunks, "part").mapInArrow(run, "query_id long, vec_id long, score long")


def best(found: DataFrame, k: int) -> DataFrame:
    """The first k of each query, with their rank; Spark cuts each task's rows to k before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    scale: int = SCALE,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query with all other rows.

    `is_query` is a condition on `q_id`, the id. Ties go to the smaller id. Vectors that are NULL or hold a
    NULL or a component that is not finite take no part, nor do rows with a NULL id. A shorter
    vector counts as filled up with 0. Rows that repeat an id are candidates each; as queries the one
    whose vector is smallest stands for them, and no row with the query's id is among its results. A
    table without rows or queries gives none.
    """
    whole = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), whole_numbers(F.col(f"`{vector}`"), scale).alias("v"))
    whole = whole.filter("id IS NOT NULL AND v IS NOT NULL")
    blocks = stored(packed(whole, BLOCK), "vector-blocks")
    asked = whole.withColumn("q_id", F.col("id")).filter(is_query).groupBy("id").agg(F.min("v").alias("v"))
    chunks = stored(packed(asked, QUERIES).drop("high", "low"), "query-chunks")
    return _search(blocks, chunks, k)


def summaries_of(blocks: DataFrame) -> DataFrame:
    """Term maxima and minima of about `SUMMARIES` blocks per row, in a fixed order."""
    groups = max(1, -(-blocks.count() // SUMMARIES))
    edges = F.struct(F.col("part").alias("block"), "width", "high", "low")
    grouped = blocks.groupBy(F.pmod(F.xxhash64("part"), F.lit(groups)).alias("of"))
    return stored(grouped.agg(F.sort_array(F.collect_list(edges)).alias("blocks")).select("blocks"), "summaries")


def _with_kth(chunks: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The chunks with each query's k-th score, in the order of their ids."""
    kth = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth"))
    asked = chunks.select("part", F.posexplode("ids").alias("place", "id"))
    known = asked.join(kth, "id", "left").withColumn("kth", F.coalesce("kth", F.lit(NONE)))
    line = known.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("place", "kth"))).alias("line"))
    return chunks.join(line.select("part", F.col("line.kth").alias("kth")), "part")


def _search(blocks: DataFrame, chunks: DataFrame, k: int) -> DataFrame:
    """Waves of blocks until no query wants another one."""
    spark = blocks.sparkSession
    summaries = summaries_of(blocks)
    found = spark.createDataFrame([], "query_id long, vec_id long, score long, rank int")
    done, wave = 0, FIRST_WAVE
    while True:
        now = stored(_with_kth(chunks, found, k), "query-chunks")
        wants = stored(wanted(now, summaries, done, wave), "wanted-blocks")
        if not wants.limit(1).count():
            return found.select("query_id", "rank", "vec_id", "score")
        new = scored(wants, blocks, now, k)
        found = stored(best(found.drop("rank").union(new), k), "best-so-far")
        done, wave = done + wave, wave * GROWTH
