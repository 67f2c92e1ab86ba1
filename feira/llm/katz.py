"""Katz back-off language model over word pairs, learned from and applied to whole corpora.

Texts are packed into blocks of some megabytes. A block asks for the counts of its different words and
pairs of words, each as a 64-bit hash: sorted, as differences, compressed, and dealt by hash range to
buckets. A bucket adds what all blocks have counted, keeps the sums as its part of the model's tables, and
answers each block in the order of its question. So a word or pair crosses the network once per block
that has it, however often it occurs; a frequent one is one entry of each block's question, and no task
holds more than a range of hashes.

P(w | h) is d(c) * c(h w) / c(h) for pairs seen in training, with Good-Turing discounts d(c) for counts up to 5,
and alpha(h) * P(w) for others, where P(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1)). alpha(h) makes
the probabilities of all V + 1 words after h sum to one: what the pairs of h leave over, shared among the words
not seen after h. Words of the whole pair table are needed for it; each pair is accounted for by the first
block that has it, the sums per h go to the bucket of h, and come back as alpha(h).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StructField,
    StructType,
)

from feira.llm.hashing import CHUNK, mix
from feira.llm.tables import stored

BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20
SMOOTHING = 0.1
# Pairs seen more often than this keep their full count.
DISCOUNTED = 5
WORDS, PAIRS, HISTORIES = 0, 1, 2
# Stand for the end of a text, which is a token, and for its beginning, which is not.
END = int.from_bytes(b"text end", "big")
BEGIN = int.from_bytes(b"text beg", "big")
PAIR = 0xD6E8FEB86659FD93
LEVEL = 1


# --- arrays of whole numbers as bytes


def squeeze(values: np.ndarray, rising: bool = False) -> bytes:
    """Non-negative whole numbers, one byte place after the other, compressed; rising ones as differences."""
    values = values.astype(np.uint64)
    if rising:
        values = np.diff(values, prepend=np.uint64(0))
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.ZstdCompressor(level=LEVEL).compress(planes)


def unsqueeze(data: bytes, rising: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    values = np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(values, dtype=np.uint64) if rising else values


def squeeze_reals(values: np.ndarray) -> bytes:
    return squeeze(values.astype("<f8").view("<u8"))


def unsqueeze_reals(data: bytes) -> np.ndarray:
    return unsqueeze(data).view("<f8")


# --- blocks of texts


def text_blocks(docs: DataFrame, key: str, text: str, held_out: Column) -> DataFrame:
    """(block, ids, held, sizes, data): texts of neighbouring rows, lower-cased (A-Z) and compressed."""
    picked = docs.select(
        F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"), held_out.alias("h")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids, held, texts, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 32) + number], pa.int64()),
                    pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(kind)),
                    pa.array([held], pa.list_(pa.bool_())),
                    pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                    pa.array([zstandard.ZstdCompressor(level=6).compress(b"".join(texts))]),
                ],
                ["block", "ids", "held", "sizes", "data"],
            )

        kind = None
        for batch in batches:
            kind = batch.column(0).type
            for i, (value, out) in enumerate(zip(batch.column(1), batch.column(2))):
                ids.append(batch.column(0).slice(i, 1))
                held.append(out.as_py())
                texts.append((value.as_py() or "").encode().lower())
                size += len(texts[-1]) + 64
                if size >= BLOCK_BYTES:
                    yield close()
                    number, ids, held, texts, size = number + 1, [], [], [], 0
        if ids:
            yield close()

    shape = f"block long, ids array<{picked.schema['k'].dataType.simpleString()}>, held array<boolean>, sizes array<long>, data binary"
    return picked.mapInArrow(run, shape)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different values, where each stands first, and the place of every value among them.

    As `np.unique`, in half the memory.
    """
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    new = np.r_[np.ones(min(1, len(ranked)), bool), ranked[1:] != ranked[:-1]]
    found, at = ranked[new], order[new]
    del ranked
    ranks = np.cumsum(new, dtype=np.int32)
    ranks -= 1
    place = np.empty(len(values), np.int32)
    place[order] = ranks
    return found, at, place


class Block:
    """The different words and pairs of a block's texts, and where each is.

    Arrays as long as the tokens are the most of a worker's memory, so they have 32 bits where they stay, and are dropped
    where they do not.
    """

    def __init__(self, held: list[bool], sizes: list[int], data: bytes):
        tokens, self.counts = self._tokens(sizes, data)
        self.owners = np.repeat(np.arange(len(sizes), dtype=np.int32), self.counts + 1)
        self.train = ~np.array(held, bool)[self.owners]
        first = np.r_[np.ones(min(1, len(self.owners)), bool), self.owners[1:] != self.owners[:-1]]
        self.words, _, self.word_of = _distinct(tokens)
        keys = np.r_[np.zeros(min(1, len(tokens)), np.uint64), tokens[:-1]]
        keys[first] = np.uint64(BEGIN)
        keys *= np.uint64(PAIR)
        keys += tokens
        del tokens
        keys = mix(keys)
        self.pairs, at, self.pair_of = _distinct(keys)
        del keys
        # The different words and the beginning, as histories.
        self.histories = np.unique(np.r_[self.words, np.uint64(BEGIN)])
        places = np.searchsorted(self.histories, self.words).astype(np.int32)
        self.pair_word = self.word_of[at]
        self.pair_history = places[self.word_of[at - 1]]
        self.pair_history[first[at]] = np.searchsorted(self.histories, np.uint64(BEGIN))

    @classmethod
    def _tokens(cls, sizes: list[int], data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all tokens, and the number of words of each text."""
        whole = zstandard.ZstdDecompressor().decompress(data)
        hashes, counts = [], []
        at, words, size = 0, [], 0
        for n in sizes:
            own = whole[at : at + n].split()
            at, size = at + n, size + n
            words += own
            counts.append(len(own))
            if size >= CHUNK:
                hashes.append(cls._hash(words))
                words, size = [], 0
        hashes.append(cls._hash(words))
        del whole, words
        spoken, numbers = np.concatenate(hashes), np.array(counts, np.int64)
        del hashes
        return np.insert(spoken, np.cumsum(numbers), np.uint64(END)), numbers

    @staticmethod
    def _hash(words: list[bytes]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.uint64)
        return pd.util.hash_array(np.array(words, dtype=object), categorize=False)

    def trained(self, places: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(places[self.train], minlength=size)

    def history_counts(self, words: np.ndarray) -> np.ndarray:
        """The count of each history, from those of the words."""
        # The beginning was seen once per training text, as the end was.
        known = np.searchsorted(self.words, self.histories)
        end = np.searchsorted(self.words, np.uint64(END))
        begin = self.histories == np.uint64(BEGIN)
        return words[np.where(begin, end, np.minimum(known, len(words) - 1))]


def _singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row as a batch, so that only one is copied into Python objects at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1)


QUESTION = "kind int, bucket long, block long, keys binary, values binary"
QUESTIONS = pa.schema(
    [("kind", pa.int32()), ("bucket", pa.int64()), ("block", pa.int64()), ("keys", pa.binary()), ("values", pa.binary())]
)


def _questions(kind: int, block: int, keys: np.ndarray, values: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """One row for each bucket that has some of the sorted keys; `values` has a row per number of a key."""
    buckets = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    cuts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1], True]) if len(keys) else []
    rows = [
        {
            "kind": kind,
            "bucket": int(buckets[begin]),
            "block": block,
            "keys": squeeze(keys[begin:end], rising=True),
            "values": squeeze(values[:, begin:end].ravel()),
        }
        for begin, end in zip(cuts[:-1], cuts[1:])
    ]
    if rows:
        yield pa.RecordBatch.from_pylist(rows, QUESTIONS)


def questions(blocks: DataFrame, bits: int) -> DataFrame:
    """What each block has counted in its training texts, for each of its words and pairs."""

    # What a call for one block has built is gone before the next block is.
    def asked(row: dict) -> Iterator[pa.RecordBatch]:
        block = Block(row["held"], row["sizes"], row["data"])
        for kind, keys, places in (
            (WORDS, block.words, block.word_of),
            (PAIRS, block.pairs, block.pair_of),
        ):
            counts = block.trained(places, len(keys))
            yield from _questions(kind, row["block"], keys, counts[None, :], bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for single in _singles(batches):
            yield from asked(single.to_pylist()[0])

    return blocks.select("block", "held", "sizes", "data").mapInArrow(run, QUESTION)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[dict]]]:
    """The rows of each (kind, bucket), which stand together."""
    rows = (row for single in _singles(batches) for row in single.to_pylist())
    for (kind, bucket), group in groupby(rows, key=lambda row: (row["kind"], row["bucket"])):
        yield kind, bucket, list(group)


ANSWER = "what string, kind int, bucket long, block long, keys binary, counts binary, own binary, stats array<long>"
ANSWERS = pa.schema(
    [
        ("what", pa.string()),
        ("kind", pa.int32()),
        ("bucket", pa.int64()),
        ("block", pa.int64()),
        ("keys", pa.binary()),
        ("counts", pa.binary()),
        ("own", pa.binary()),
        ("stats", pa.list_(pa.int64())),
    ]
)


def counted(asked: DataFrame) -> DataFrame:
    """The sums of each bucket, as `table` rows, answers to the blocks, and statistics.

    An answer has the sum for each key of the question, and whether the block is the first that has the key
    in training. Statistics are N and V for words, and the number of pairs seen once, twice, ... for pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, bucket, rows in _buckets(batches):
            parts = [unsqueeze(row["keys"], rising=True) for row in rows]
            values = np.concatenate([unsqueeze(row["values"]) for row in rows]).astype(np.int64)
            keys, place = np.unique(np.concatenate(parts), return_inverse=True)
            sums = np.bincount(place, weights=values, minlength=len(keys)).astype(np.int64)
            first = np.full(len(keys), len(place))
            trained = np.flatnonzero(values > 0)
            np.minimum.at(first, place[trained], trained)
            base = {"kind": kind, "bucket": bucket}
            out, begin = [], 0
            for row, part in zip(rows, parts):
                at = place[begin : begin + len(part)]
                own = first[at] == np.arange(begin, begin + len(part))
                out.append(
                    base | {"what": "answer", "block": row["block"], "counts": squeeze(sums[at]), "own": squeeze(own)}
                )
                begin += len(part)
            seen = sums > 0
            if kind == WORDS:
                stats = [int(sums.sum()), int(seen.sum())]
            else:
                stats = np.bincount(np.minimum(sums, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2].tolist()
            out.append(
                base
                | {"what": "table", "keys": squeeze(keys[seen], rising=True), "counts": squeeze(sums[seen]), "stats": stats}
            )
            yield pa.RecordBatch.from_pylist(out, ANSWERS)

    dealt = asked.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket", "block")
    return dealt.mapInArrow(run, ANSWER)


def discounts(of_counts: list[int]) -> np.ndarray:
    """Good-Turing discount for each count up to `DISCOUNTED`, from the numbers of pairs seen 1, 2, ... times.

    Where these numbers give no factor between 0 and 1, the count is not discounted.
    """
    n = np.array(of_counts, float)
    k = DISCOUNTED
    factors = np.ones(k + 1)
    if (n <= 0).any():
        return factors
    common = (k + 1) * n[k] / n[0]
    for r in range(1, k + 1):
        better = (r + 1) * n[r] / n[r - 1]
        factor = (better / r - common) / (1 - common) if common < 1 else 1.0
        factors[r] = factor if 0 < factor < 1 else 1.0
    return factors


def _ordered(parts: list[dict], name: str) -> np.ndarray:
    """The answers of all buckets in the order of the block's keys."""
    return np.concatenate([unsqueeze(p[name]) for p in sorted(parts, key=lambda p: p["bucket"])])


# Of a history: pairs seen 1 to 5 times, pairs seen more often, the sum of their counts, the sum of c(w) over
# all its pairs; and its own count.
PLANES = DISCOUNTED + 4


def history_questions(joined: DataFrame, bits: int) -> DataFrame:
    """Per block and history, sums over the pairs that the block accounts for."""

    def asked(row: dict) -> Iterator[pa.RecordBatch]:
        block = Block(row["held"], row["sizes"], row["data"])
        words = _ordered(row["words"], "counts").astype(np.int64)
        pairs = _ordered(row["pairs"], "counts").astype(np.int64)
        own = _ordered(row["pairs"], "own").astype(bool)
        size = len(block.histories)
        at, count = block.pair_history[own], pairs[own]
        planes = np.zeros((PLANES, size), np.int64)
        for r in range(1, DISCOUNTED + 1):
            planes[r - 1] = np.bincount(at[count == r], minlength=size)
        large = count > DISCOUNTED
        planes[DISCOUNTED] = np.bincount(at[large], minlength=size)
        planes[DISCOUNTED + 1] = np.bincount(at[large], weights=count[large], minlength=size)
        planes[DISCOUNTED + 2] = np.bincount(at, weights=words[block.pair_word[own]], minlength=size)
        planes[DISCOUNTED + 3] = block.history_counts(words)
        yield from _questions(HISTORIES, row["block"], block.histories, planes, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for single in _singles(batches):
            yield from asked(single.to_pylist()[0])

    return joined.mapInArrow(run, QUESTION)


def backoffs(asked: DataFrame, factors: np.ndarray, total: int, distinct: int) -> DataFrame:
    """Per bucket, alpha and scale of each history, as `table` rows and as answers.

    Where the pairs of a history leave nothing over, they are scaled as if the history had been seen once more.
    """
    whole = total + SMOOTHING * (distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, bucket, rows in _buckets(batches):
            parts = [unsqueeze(row["keys"], rising=True) for row in rows]
            planes = np.concatenate(
                [unsqueeze(row["values"]).astype(np.int64).reshape(PLANES, -1) for row in rows], axis=1
            )
            keys, place = np.unique(np.concatenate(parts), return_inverse=True)
            sums = np.array([np.bincount(place, weights=plane, minlength=len(keys)) for plane in planes[:-1]])
            count = np.zeros(len(keys))
            np.maximum.at(count, place, planes[-1])
            ranks = np.arange(1, DISCOUNTED + 1)
            kept = (sums[:DISCOUNTED] * (ranks * factors[1:])[:, None]).sum(axis=0) + sums[DISCOUNTED + 1]
            some = np.maximum(count, 1)
            left = np.where(count > 0, 1 - kept / some, 1.0)
            full = (count > 0) & (left < 1e-9)
            scale = np.where(full, some / (some + 1), 1.0)
            left = np.where(full, 1 / (some + 1), left)
            n_pairs = sums[: DISCOUNTED + 1].sum(axis=0)
            unseen = 1 - (sums[DISCOUNTED + 2] + SMOOTHING * n_pairs) / whole
            alpha = left / unseen
            out = [
                {"bucket": bucket, "what": "table", "keys": squeeze(keys, rising=True), "alpha": squeeze_reals(alpha), "scale": squeeze_reals(scale)}
            ]
            begin = 0
            for row, part in zip(rows, parts):
                at = place[begin : begin + len(part)]
                begin += len(part)
                out.append(
                    {"bucket": bucket, "what": "answer", "block": row["block"], "alpha": squeeze_reals(alpha[at]), "scale": squeeze_reals(scale[at])}
                )
            yield pa.RecordBatch.from_pylist(out, schema)

    schema = pa.schema(
        [
            ("what", pa.string()),
            ("bucket", pa.int64()),
            ("block", pa.int64()),
            ("keys", pa.binary()),
            ("alpha", pa.binary()),
            ("scale", pa.binary()),
        ]
    )
    dealt = asked.repartition("bucket").sortWithinPartitions("bucket", "block")
    return dealt.mapInArrow(run, "what string, bucket long, block long, keys binary, alpha binary, scale binary")


def scored(joined: DataFrame, key_type, factors: np.ndarray, total: int, distinct: int) -> DataFrame:
    """The scores of every text of the blocks."""
    whole = total + SMOOTHING * (distinct + 1)
    schema = StructType(
        [
            StructField("doc_id", key_type),
            StructField("held_out", BooleanType()),
            StructField("n_tokens", LongType()),
            StructField("n_known", LongType()),
            StructField("train_tokens", LongType()),
            StructField("base_score", DoubleType()),
            StructField("score", DoubleType()),
        ]
    )

    factor = np.r_[factors, 1.0]

    def answered(ids: pa.Array, row: dict) -> pa.RecordBatch:
        block = Block(row["held"], row["sizes"], row["data"])
        n = len(block.counts)

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.bincount(block.owners, weights=values, minlength=n)

        words = _ordered(row["words"], "counts").astype(np.int64)
        pairs = _ordered(row["pairs"], "counts").astype(np.int64)
        order = sorted(row["backoffs"], key=lambda p: p["bucket"])
        alpha, scale = [np.concatenate([unsqueeze_reals(p[name]) for p in order]) for name in ("alpha", "scale")]
        base = (words + SMOOTHING) / whole
        # Once for each different pair, however often it occurs.
        chance = factor[np.minimum(pairs, DISCOUNTED + 1)]
        chance *= pairs
        chance /= np.maximum(block.history_counts(words), 1)[block.pair_history]
        chance *= scale[block.pair_history]
        unseen = pairs == 0
        chance[unseen] = alpha[block.pair_history[unseen]] * base[block.pair_word[unseen]]
        del pairs, unseen
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array(row["held"], pa.bool_()),
                pa.array(block.counts + 1),
                pa.array(per_text((words > 0)[block.word_of]).astype(np.int64)),
                pa.array(np.full(n, total, np.int64)),
                pa.array(per_text(np.log10(base)[block.word_of])),
                pa.array(per_text(np.log10(chance)[block.pair_of])),
            ],
            schema.fieldNames(),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for single in _singles(batches):
            ids = single.column(single.schema.get_field_index("ids")).flatten()
            yield answered(ids, single.drop_columns(["ids"]).to_pylist()[0])

    return joined.mapInArrow(run, schema)


def held_out(key: Column, folds: int = 10) -> Column:
    """True where the CRC-32 of the key as text leaves 0; a NULL key is an empty text."""
    return F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")) % folds == 0


def scores(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of `docs`.

    The model learns from the rows that are not held out and scores all of them; `base_score` is that of the
    smoothed word counts alone. A NULL or empty text is one token, its end. Repeated rows count each. Rows with a
    NULL key are held out. Where no row is left to learn from, every word is unknown and has probability 1. Other
    columns are left out; a table without rows gives none.
    """
    held = held_out(F.col(f"`{key}`"))
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    bits = max(0, (max(1, size // BUCKET_BYTES) - 1).bit_length())
    blocks = stored(text_blocks(docs, key, text, held), "text-blocks")
    model = stored(counted(questions(blocks, bits)), "pair-counts")
    tables = model.filter("what = 'table'")
    stats = {
        row["kind"]: [int(n) for n in row["sums"]]
        for row in tables.select("kind", F.posexplode("stats").alias("place", "n"))
        .groupBy("kind", "place").agg(F.sum("n").alias("n"))
        .groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("place", "n")))["n"].alias("sums"))
        .collect()
    }
    total, distinct = stats.get(WORDS, [0, 0])
    factors = discounts(stats.get(PAIRS, [0] * (DISCOUNTED + 1)))

    answers = model.filter("what = 'answer'")
    parts = answers.groupBy("block").agg(
        *[
            F.collect_list(F.when(F.col("kind") == kind, F.struct("bucket", "counts", "own"))).alias(name)
            for kind, name in ((WORDS, "words"), (PAIRS, "pairs"))
        ]
    )
    joined = blocks.join(parts, "block")
    asked = history_questions(joined.select("block", "held", "sizes", "data", "words", "pairs"), bits)
    back = stored(backoffs(asked, factors, total, distinct), "backoffs")
    replies = back.filter("what = 'answer'").groupBy("block").agg(
        F.collect_list(F.struct("bucket", "alpha", "scale")).alias("backoffs")
    )
    key_type = docs.select(F.col(f"`{key}`")).schema[0].dataType
    return scored(joined.join(replies, "block"), key_type, factors, total, distinct)
