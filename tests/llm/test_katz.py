from __future__ import annotations

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql.types import LongType

from conftest_llm import LONG
from feira.llm import katz


class Brute:
    """The model in dictionaries."""

    def __init__(self, rows):
        tokens = [(k, [*(t or "").encode().lower().split(), "end"]) for k, t in rows]
        train = [ws for k, ws in tokens if zlib.crc32(("" if k is None else str(k)).encode()) % 10]
        self.words = Counter(w for ws in train for w in ws)
        self.pairs = Counter(p for ws in train for p in zip(["begin", *ws], ws))
        self.total, distinct = sum(self.words.values()), len(self.words)
        self.whole = self.total + 0.1 * (distinct + 1)
        self.factor = katz.discounts([sum(c == r for c in self.pairs.values()) for r in range(1, 7)])
        self.count, self.kept, self.seen = Counter(), defaultdict(float), defaultdict(float)
        for (h, w), c in self.pairs.items():
            self.count[h] += c
            self.kept[h] += self.discount(c) * c
            self.seen[h] += self.base(w)

    def discount(self, c):
        return self.factor[c] if c <= 5 else 1.0

    def base(self, w):
        return (self.words[w] + 0.1) / self.whole

    def chance(self, h, w):
        n = self.count[h]
        if not n:
            return self.base(w)
        left, scale = 1 - self.kept[h] / n, 1.0
        if left < 1e-9:
            left, scale = 1 / (n + 1), n / (n + 1)
        c = self.pairs[(h, w)]
        return self.discount(c) * c / n * scale if c else left / (1 - self.seen[h]) * self.base(w)


def check(documents, rows):
    model = Brute(rows)
    found = katz.scores(documents(*rows)).collect()
    assert len(found) == len(rows)
    expected = []
    for k, text in rows:
        ws = [*(text or "").encode().lower().split(), "end"]
        score = sum(math.log10(model.chance(h, w)) for h, w in zip(["begin", *ws], ws))
        base = sum(math.log10(model.base(w)) for w in ws)
        held = zlib.crc32(("" if k is None else str(k)).encode()) % 10 == 0
        expected.append((k, held, len(ws), sum(w in model.words for w in ws), model.total, base, score))
    order = lambda row: repr(row[:4])
    for got, want in zip(sorted(map(tuple, found), key=order), sorted(expected, key=order), strict=True):
        assert got[:5] == want[:5] and got[5:] == pytest.approx(want[5:], rel=1e-9)
    return model


def test_scores_and_sums_to_one(documents):
    draw = random.Random(5)
    words = [f"w{int(draw.paretovariate(0.7))}" for _ in range(9000)]
    rows = [(i, " ".join(words[i * 30 : i * 30 + draw.randrange(31)])) for i in range(300)]
    model = check(documents, rows)
    assert (model.factor[1:] < 1).any()
    for h in ("begin", b"w1", b"w2", b"never"):
        assert sum(model.chance(h, w) for w in [*model.words, "unknown"]) == pytest.approx(1)


def test_awkward_rows(documents):
    check(documents, [
        (None, "The the THE"), (1, None), (2, ""), (3, "a b a b"), (3, "a b a b"), (4, "É é x"), (5, LONG), (1, "c"),
    ])


def test_nothing_to_learn_from(documents):
    rows = [(k, "a b") for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0]
    assert {(r.n_known, r.train_tokens, r.score, r.base_score) for r in katz.scores(documents(*rows)).collect()} == {(0, 0, 0.0, 0.0)}


def test_empty_table(documents):
    assert katz.scores(documents((1, "x")).filter("false")).count() == 0


def test_many_buckets_and_blocks(documents, monkeypatch):
    monkeypatch.setattr(katz, "BUCKET_BYTES", 256)
    monkeypatch.setattr(katz, "BLOCK_BYTES", 512)
    check(documents, [(i, " ".join(f"v{(i * j) % 13}" for j in range(i % 40))) for i in range(120)])


class Rows:
    """Stands for a DataFrame; gives the function that a step runs on the batches of a task."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):  # noqa: N802
        return run


def test_memory_of_a_worker(monkeypatch):
    monkeypatch.setattr(katz, "CHUNK", 1 << 14)
    draw = random.Random(3)
    texts = [" ".join(f"w{int(draw.paretovariate(0.7)) % 10**9}" for _ in range(500)).encode() for _ in range(400)]
    sizes, held, data = [*map(len, texts)], [False] * len(texts), zstandard.compress(b"".join(texts))
    block = katz.Block(held, sizes, data)
    n = len(block.owners)
    ones = [{"bucket": 0, "counts": katz.squeeze(x), "own": katz.squeeze(x)} for x in (np.ones(len(block.words)), np.ones(len(block.pairs)))]
    half = katz.squeeze_reals(np.full(len(block.histories), 0.5))
    row = {
        "block": 0, "ids": [*range(len(texts))], "held": held, "sizes": sizes, "data": data, "words": ones[:1], "pairs": ones[1:],
        "backoffs": [{"bucket": 0, "alpha": half, "scale": half}],
    }
    del block, texts
    for run in (
        katz.questions(Rows(), 2),
        katz.history_questions(Rows(), 2),
        katz.scored(Rows(), LongType(), np.ones(katz.DISCOUNTED + 1), n, 1000),
    ):
        batches = [pa.RecordBatch.from_pylist([row] * 3)] * 2
        tracemalloc.start()
        for _ in run(iter(batches)):
            pass
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        # Bytes per token of one block, whatever number of blocks a task has.
        assert most < 130 * n


@pytest.mark.parametrize("values", [[], [7], [7, 7, 7], [3, 1, 2**64 - 1, 3, 0, 1, 3]])
def test_distinct_as_numpy(values):
    values = np.array(values, np.uint64)
    for found, wanted in zip(katz._distinct(values), np.unique(values, return_index=True, return_inverse=True), strict=True):
        assert found.tolist() == wanted.tolist()


@given(st.lists(st.integers(0, 2**63), max_size=50))
def test_squeezed_numbers(values):
    array = np.array(sorted(values), np.uint64)
    assert (katz.unsqueeze(katz.squeeze(array, rising=True), rising=True) == array).all()
    assert (katz.unsqueeze(katz.squeeze(array[::-1])) == array[::-1]).all()


def test_discounts():
    assert (katz.discounts([0, 5, 3, 2, 1, 1]) == 1).all()
    found = katz.discounts([1000, 300, 150, 90, 60, 40])
    assert found[0] == 1 and (0 < found[1:]).all() and (found[1:] < 1).all()
