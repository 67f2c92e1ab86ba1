"""Removal of passages that a document with a smaller id has too, by a Count-min prefilter.

A window is a run of words. Each window has an anchor: the least hash of the shorter word runs inside it.
Equal windows have equal anchors, so the number of documents with an anchor bounds the number of those
with any of its windows from above, and there are about eleven times fewer anchors than windows.

1. Every partition counts, per anchor, the documents that have it, in a Count-min sketch; the partition
   sketches are merged by adding, cell by cell, in tasks that hold a section of the cells each.
2. A second pass over the texts keeps the windows whose anchor the sketch puts in two documents or more.
   It can keep too many, never too few. They are grouped by 96 bits of hash, and each learns the
   smallest document that has it.
3. Words under a window that a smaller document has are taken out of the texts.

The sketch has a row of `cells` per hash function, sized by the input up to `MOST_CELLS`, so that what is
broadcast, one bit a cell, stays under 16 MB. Beyond some 20 million anchors it lets more windows through;
results do not change. A window that very many documents share is combined in the tasks that read it, is one
row of the table of smallest documents, and is split by AQE where that table is joined.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from feira.llm.hashing import BASES, Chunk, chunks, mix, rolling, sliding_min
from feira.llm.tables import stored

WINDOW = 50
# Words of the runs that anchors are chosen from; at most half of a window and more.
GRAM = 30
SALTS = (0x51ED270B0A1F39C1, 0xA3AAC6C1D1F0B5E7)
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 26
SECTION = 1 << 20
# A task sends a partial sketch after so many anchors.
FLUSH = 1 << 21

SKETCH = StructType(
    [
        StructField("row", IntegerType()),
        StructField("section", IntegerType()),
        StructField("cells", BinaryType()),
        StructField("counts", BinaryType()),
    ]
)
MERGED = StructType(
    [
        StructField("row", IntegerType()),
        StructField("section", IntegerType()),
        StructField("repeated", BinaryType()),
    ]
)


def sketch_cells(text_bytes: int) -> int:
    """Cells per row: about four times the anchors to expect, a power of two within the bounds."""
    expected = max(1, text_bytes // 16)
    return min(MOST_CELLS, max(LEAST_CELLS, 1 << (expected - 1).bit_length()))


def _windows(chunk: Chunk, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words; where windows start, in which row of the chunk, and their anchors."""
    x = chunk.hashes()
    owners = chunk.owners()
    starts = np.flatnonzero(owners[: max(0, len(owners) - window + 1)] == owners[window - 1 :])
    anchors = sliding_min(mix(rolling(x, gram)), window - gram + 1)[starts]
    return x, starts, owners[starts], anchors


def _cells(anchors: np.ndarray, row: int, cells: int) -> np.ndarray:
    return mix(anchors ^ np.uint64(SALTS[row])) & np.uint64(cells - 1)


def _partial(anchors: list[np.ndarray], cells: int) -> Iterator[dict]:
    """The sketch of some anchors, one row per section that has any; counts stop at 255."""
    every = np.concatenate(anchors)
    for row in range(len(SALTS)):
        cell, count = np.unique(_cells(every, row, cells), return_counts=True)
        section = (cell // SECTION).astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, section[1:] != section[:-1], True])
        for begin, end in zip(cuts[:-1], cuts[1:]):
            yield {
                "row": row,
                "section": int(section[begin]),
                "cells": (cell[begin:end] % SECTION).astype("<u4").tobytes(),
                "counts": np.minimum(count[begin:end], 255).astype(np.uint8).tobytes(),
            }


def partition_sketches(texts: DataFrame, cells: int, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Partial sketches of the column `t`; a document counts once for each of its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("row", pa.int32()), ("section", pa.int32()), ("cells", pa.binary()), ("counts", pa.binary())]
        )
        held, size = [], 0
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                _, _, owners, anchors = _windows(chunk, window, gram)
                if not len(anchors):
                    continue
                order = np.lexsort((anchors, owners))
                a, o = anchors[order], owners[order]
                held.append(a[np.r_[True, (a[1:] != a[:-1]) | (o[1:] != o[:-1])]])
                size += len(held[-1])
                if size >= FLUSH:
                    yield pa.RecordBatch.from_pylist(list(_partial(held, cells)), schema)
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(list(_partial(held, cells)), schema)

    return texts.mapInArrow(run, SKETCH)


def merged_sketch(partial: DataFrame, cells: int) -> DataFrame:
    """The sums of all partial sketches: per section, a bit per cell for counts of 2 or more."""
    width = min(cells, SECTION)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sections: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row, section, cell, count in zip(*[column.to_pylist() for column in batch.columns]):
                counts = sections.setdefault((row, section), np.zeros(width, np.uint8))
                at = np.frombuffer(cell, "<u4")
                counts[at] = np.minimum(counts[at].astype(np.uint16) + np.frombuffer(count, np.uint8), 255)
        for (row, section), counts in sections.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row], pa.int32()),
                    pa.array([section], pa.int32()),
                    pa.array([np.packbits(counts >= 2).tobytes()]),
                ],
                MERGED.fieldNames(),
            )

    return partial.repartition("row", "section").mapInArrow(run, MERGED)


def _joined(rows: list, cells: int) -> list[bytes]:
    """The bits of each sketch row in one piece."""
    width = min(cells, SECTION) // 8
    bits = [bytearray(cells // 8) for _ in SALTS]
    for found in rows:
        begin = found["section"] * width
        bits[found["row"]][begin : begin + width] = found["repeated"]
    return [bytes(b) for b in bits]


def _set(bits: list[np.ndarray], anchors: np.ndarray, cells: int) -> np.ndarray:
    """Where all rows have the anchor's bit."""
    found = np.ones(len(anchors), bool)
    for row, held in enumerate(bits):
        cell = _cells(anchors, row, cells)
        shift = (np.uint64(7) - (cell & np.uint64(7))).astype(np.uint8)
        found &= ((held[cell >> np.uint64(3)] >> shift) & 1).astype(bool)
    return found


def candidates(
    texts: DataFrame, sketch, cells: int, window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """(h1, h2, k, c, at): windows of (k, t) whose anchor may be in two documents or more.

    `c` is the CRC-32 of the text, which tells rows of one key apart; `at` is the first word.
    """
    kind = texts.schema["k"]
    schema = StructType(
        [
            StructField("h1", LongType()),
            StructField("h2", IntegerType()),
            StructField("k", kind.dataType),
            StructField("c", LongType()),
            StructField("at", IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = [np.frombuffer(bits, np.uint8) for bits in sketch.value]
        for batch in batches:
            keys, column = batch.column(0), batch.column(1)
            for chunk in chunks(column):
                x, starts, owners, anchors = _windows(chunk, window, gram)
                if not len(starts):
                    continue
                # Windows in a row share anchors, which are looked up once.
                change = np.r_[True, anchors[1:] != anchors[:-1]]
                run_of = np.cumsum(change) - 1
                own = anchors[change]
                chosen = _set(repeated, own, cells)[run_of]
                starts, owners = starts[chosen], owners[chosen]
                if not len(starts):
                    continue
                h1 = mix(rolling(x, window, BASES[0])[starts]).view(np.int64)
                h2 = (mix(rolling(x, window, BASES[1])[starts]) >> np.uint64(32)).astype(np.uint32).view(np.int32)
                begins = np.cumsum(chunk.counts) - chunk.counts
                sums = np.zeros(len(chunk.counts), np.int64)
                for i in np.unique(owners):
                    sums[i] = zlib.crc32((column[chunk.begin + int(i)].as_py() or "").encode())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(h1),
                        pa.array(h2),
                        keys.take(pa.array(owners + chunk.begin)),
                        pa.array(sums[owners]),
                        pa.array((starts - begins[owners]).astype(np.int32)),
                    ],
                    schema.fieldNames(),
                )

    return texts.mapInArrow(run, schema)


def later_windows(found: DataFrame) -> DataFrame:
    """(k, c, at) of the windows that a document with a smaller key has too; NULL keys are left alone."""
    known = found.filter("k IS NOT NULL")
    firsts = known.groupBy("h1", "h2").agg(F.min("k").alias("first"), F.max("k").alias("last"))
    firsts = stored(firsts.filter("first < last").select("h1", "h2", "first"), "first-windows")
    return known.join(firsts, ["h1", "h2"]).filter("k > first").select("k", "c", "at")


def covered_words(later: DataFrame) -> DataFrame:
    """(k, c, starts): per document, blocks of 64 window starts as (block, bits)."""
    dealt = later.repartition("k", "c")
    bits = F.bit_or(F.expr("shiftleft(1L, at % 64)"))
    blocks = dealt.groupBy("k", "c", F.expr("at div 64").cast("int").alias("block")).agg(bits.alias("bits"))
    return blocks.groupBy("k", "c").agg(F.collect_list(F.struct("block", "bits")).alias("starts"))


def _keep_mask(n_words: int, starts: list[dict] | None, window: int) -> np.ndarray:
    """False for the words under a window that starts at one of the marked words."""
    edges = np.zeros(n_words + 1, np.int64)
    for entry in starts or ():
        bits = np.unpackbits(np.array([entry["bits"]], "<i8").view(np.uint8), bitorder="little")
        at = entry["block"] * 64 + np.flatnonzero(bits)
        edges[at] += 1
        edges[at + window] -= 1
    return np.cumsum(edges)[:n_words] == 0


def without_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    key: str = "doc_id",
    text: str = "text",
    digest: bool = False,
) -> DataFrame:
    """`docs` with the repeated words taken out of `text`, and n_words, n_removed.

    A word goes if it lies under a window whose words also start in a document with a smaller key; all
    windows are judged on the input. A text that loses words becomes its kept words with a space between;
    other texts stay as they are. With `digest` the result is (doc_id, n_words, n_removed, kept_sha256) alone.

    NULL and empty texts have no words and texts shorter than a window lose none. A row with a NULL key
    keeps its words, and no other row loses words to it; rows with the same key lose none to each other.
    A result replaces an input column of its name. A table without rows gives none.
    """
    spark = docs.sparkSession
    names = [c for c in docs.columns if c.lower() not in ("n_words", "n_removed")]
    texts = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    size = texts.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    cells = sketch_cells(size)
    merged = merged_sketch(partition_sketches(texts.select("t"), cells, window, gram), cells)
    # A bit for each of 2 * MOST_CELLS cells: 16 MB at most.
    sketch = spark.sparkContext.broadcast(_joined(merged.collect(), cells))
    found = stored(candidates(texts, sketch, cells, window, gram), "candidate-windows")
    covered = stored(covered_words(later_windows(found)), "covered-words").hint("shuffle_hash")
    whole = docs.select(
        F.col(f"`{key}`").alias("k"),
        F.crc32(F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8")).alias("c"),
        F.col(f"`{text}`").alias("t"),
        *([] if digest else [F.struct(*[F.col(f"`{c}`") for c in names if c != text]).alias("rest")]),
    )
    joined = whole.join(covered, ["k", "c"], "left")

    def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks = batch.column("t"), batch.column("starts")
            kept, counts, lost, sums = [], [], [], []
            for value, starts in zip(texts, marks):
                whole, starts = value.as_py(), starts.as_py()
                words = (whole or "").encode().split()
                if starts:
                    mask = _keep_mask(len(words), starts, window)
                    left = [w for w, ok in zip(words, mask.tolist()) if ok]
                else:
                    left = words
                counts.append(len(words))
                lost.append(len(words) - len(left))
                if digest:
                    sums.append(hashlib.sha256(b" ".join(left)).hexdigest())
                else:
                    kept.append(whole if len(left) == len(words) else b" ".join(left).decode())
            numbers = [pa.array(counts, pa.int64()), pa.array(lost, pa.int64())]
            if digest:
                yield pa.RecordBatch.from_arrays([batch.column("k"), *numbers, pa.array(sums, pa.string())], shape.fieldNames())
            else:
                yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(kept, pa.string()), *numbers], shape.fieldNames())

    counted = [StructField("n_words", LongType()), StructField("n_removed", LongType())]
    if digest:
        shape = StructType(
            [StructField("doc_id", whole.schema["k"].dataType), *counted, StructField("kept_sha256", StringType())]
        )
        return joined.select("k", "t", "starts").mapInArrow(trim, shape)
    shape = StructType([StructField("rest", whole.schema["rest"].dataType), StructField("text", StringType()), *counted])
    done = joined.select("t", "starts", "rest").mapInArrow(trim, shape)
    columns = [F.col("text").alias(c) if c == text else F.col("rest").getField(c).alias(c) for c in names]
    return done.select(*columns, "n_words", "n_removed")
