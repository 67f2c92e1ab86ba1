from __future__ import annotations

import pytest

from conftest_llm import LONG, prose
from feira.llm import substrings


def brute(rows, window=50):
    words = [(k, (t or "").encode().split()) for k, t in rows]
    first = {}
    for k, ws in words:
        for i in range(len(ws) - window + 1):
            if k is not None:
                w = tuple(ws[i : i + window])
                first[w] = min(first.get(w, k), k)
    out = []
    for k, ws in words:
        kept = [True] * len(ws)
        for i in range(len(ws) - window + 1):
            if k is not None and first[tuple(ws[i : i + window])] < k:
                kept[i : i + window] = [False] * window
        out.append((k, len(ws), kept.count(False), b" ".join(w for w, ok in zip(ws, kept) if ok).decode()))
    return sorted(out, key=repr)


def check(documents, rows):
    docs = documents(*rows)
    found = substrings.without_repeats(docs)
    assert found.columns[:2] == ["doc_id", "text"] and "a b" in found.columns
    got = [(r.doc_id, r.n_words, r.n_removed, b" ".join((r.text or "").encode().split()).decode()) for r in found.collect()]
    assert sorted(got, key=repr) == brute(rows)
    kept = {(r.doc_id, r.text) for r in found.filter("n_removed = 0").collect()}
    assert kept <= set(rows)


def test_shared_passages_of_every_length(documents):
    shared = prose(1, 140)
    rows = [(0, " ".join(shared))]
    for i, n in enumerate((49, 50, 51, 99, 100, 140), 1):
        rows.append((i, " ".join(prose(10 + i, 30) + shared[5 : 5 + n] + prose(20 + i, 30))))
    rows.append((9, " ".join(shared[60:110] + prose(3, 10) + shared[:60])))
    check(documents, rows)


def test_awkward_rows(documents):
    copy = " ".join(prose(5, 80))
    rows = [
        (None, copy), (3, copy), (3, copy), (4, copy), (2, None), (1, ""), (5, " \n\t "), (6, "a b c"),
        (7, LONG), (8, LONG), (9, "same " * 120), (10, "same " * 70), (11, copy + " " + copy),
    ]
    check(documents, rows)


def test_hot_passage(documents):
    passage = prose(6, 60)
    check(documents, [(i, " ".join(prose(100 + i, 12) + passage + prose(500 + i, 12))) for i in range(150)])


@pytest.mark.parametrize("cells", [64, 1 << 16])
def test_full_sketch_loses_nothing(documents, cells, monkeypatch):
    monkeypatch.setattr(substrings, "MOST_CELLS", cells)
    monkeypatch.setattr(substrings, "LEAST_CELLS", cells)
    rows = [(i, " ".join(prose(i // 2, 70) + prose(1000 + i, 40))) for i in range(30)]
    check(documents, rows)


def test_empty_table(documents):
    assert substrings.without_repeats(documents((1, "x")).filter("false")).count() == 0
    assert substrings.without_repeats(documents((1, "x")).filter("false"), digest=True).count() == 0
