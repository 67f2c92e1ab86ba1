from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from conftest_llm import LONG, prose
from feira.llm import near
from feira.llm.hashing import chunks


def bags(text, size=5):
    words = (text or "").encode().split()
    if not words:
        return Counter()
    return Counter(zip(*[words[i:] for i in range(size)])) if len(words) >= size else Counter([tuple(words)])


def similarity(a, b):
    """The definition, term by term."""
    every = set(a) | set(b)
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in every) for i in set(a) & set(b))


def brute(rows, least=0.8):
    label = {k: k for k, _ in rows if k is not None}

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    held = [(k, bags(t)) for k, t in rows if k is not None and bags(t)]
    for i, (a, x) in enumerate(held):
        for b, y in held[:i]:
            if similarity(x, y) >= least:
                low, high = sorted((find(a), find(b)))
                label[high] = low
    return {k: find(k) for k in label}


def changed(words, *places):
    return " ".join(f"new{i}" if i in places else w for i, w in enumerate(words))


def check(documents, rows):
    docs = documents(*rows)
    found = near.near_classes(docs).collect()
    assert len(found) == len(rows)
    expected = brute(rows)
    assert {r.doc_id: r.class_id for r in found if r.doc_id is not None} == expected
    left = near.without_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted(set(expected.values()))
    return found


def test_groups(documents):
    a, b = prose(1, 120), prose(2, 120)
    rows = [
        (10, " ".join(a)), (3, changed(a, 60)), (7, changed(a, 60, 110)), (8, "  ".join(a)),
        (20, " ".join(b)), (21, changed(b, 10, 40, 70, 100)), (22, " ".join(b[:60])),
        (30, " ".join(prose(3, 80))), (31, "one two three"), (32, "one  two three"), (33, "one two four"),
    ]
    check(documents, rows)


def test_chains_are_one_class(documents):
    """Each text is like the next one only; the ends have little in common."""
    words = prose(4, 400)
    rows = [(100 - i, " ".join(words[i * 12 : i * 12 + 150])) for i in range(15)]
    rows = [r for r in rows]
    found = check(documents, rows)
    assert len({r.class_id for r in found}) == 1


def test_awkward_rows(documents):
    a = " ".join(prose(5, 60))
    rows = [(None, a), (1, None), (2, ""), (3, " \n"), (4, a), (4, a), (5, LONG), (6, LONG + " end"), (7, "ha " * 300), (8, "ha " * 280)]
    found = check(documents, rows)
    assert [r.class_id for r in found if r.doc_id is None] == [None]
    assert near.without_near_copies(documents(*rows)).filter("doc_id IS NULL").count() == 1
    assert near.near_classes(documents((1, "x")).filter("false")).count() == 0


def test_large_group_of_near_copies(documents):
    words = prose(6, 100)
    rows = [(i, changed(words, i % 97)) for i in range(300)] + [(1000 + i, " ".join(prose(50 + i, 60))) for i in range(50)]
    found = near.near_classes(documents(*rows)).collect()
    assert Counter(r.class_id for r in found)[0] == 300
    assert len({r.class_id for r in found}) == 51


def multiset(text):
    return near._multiset(text)


@pytest.mark.parametrize("seed", range(6))
def test_exact_similarity(seed):
    draw = np.random.default_rng(seed)
    words = lambda: " ".join(draw.choice(list("abc"), 60))
    one, two = words(), words()
    assert near.probability_jaccard(multiset(one), multiset(two)) == pytest.approx(similarity(bags(one), bags(two)))
    assert near.probability_jaccard(multiset(one), multiset(one)) == pytest.approx(1)


def test_signatures_estimate_the_similarity():
    pairs, error = [], []
    for i in range(60):
        words = prose(300 + i, 150) + ["again and again and so on"] * (i % 9)
        pairs.append((" ".join(words), " ".join(words[: 90 + i]) + " " + " ".join(prose(900 + i, i + 1))))
    for pair in pairs:
        chunk = next(chunks(pa.array(pair)))
        slots = near.signatures(*near.shingles(chunk), 2)
        error.append((slots[0] == slots[1]).mean() - near.probability_jaccard(multiset(pair[0]), multiset(pair[1])))
    # 60 estimates of 160 slots each.
    assert abs(np.mean(error)) < 0.02 and np.std(error) < 0.06


def test_signature_does_not_depend_on_neighbours():
    texts = [" ".join(prose(i, 40 + i)) for i in range(9)]
    together = near.signatures(*near.shingles(next(chunks(pa.array(texts)))), 9)
    for i, text in enumerate(texts):
        alone = near.signatures(*near.shingles(next(chunks(pa.array([text])))), 1)
        assert (alone[0] == together[i]).all()


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(205, 203), (203, 204)]
    df = spark.createDataFrame([tuple(sorted(e)) for e in edges], "a long, b long")
    found = {r.node: r.label for r in near.components(df).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[100 + i] for i in range(60)} == {100}
    assert {found[k] for k in (203, 204, 205)} == {203}


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_edges_in_two_parts(spark, seed):
    draw = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in draw.integers(0, 300, (220, 2))] + [(7, 7)]
    label = {n: n for e in edges for n in e}

    def find(n):
        return n if label[n] == n else find(label[n])

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        label[high] = low
    df = spark.createDataFrame(edges, "a long, b long")
    expected = {n: find(n) for n in label}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert {r.node: r.label for r in near.components(df).collect()} == {n: expected[n] for n in linked}
    parts = (spark.createDataFrame(part, "a long, b long") for part in (edges[:100], edges[100:]))
    found = near.joined(near.components(next(parts)), next(parts))
    assert {r.node: r.label for r in found.collect()} == {n: expected[n] for n in linked}


def test_no_link_is_lost_in_a_group_with_all_similarities(spark, documents):
    """Texts of one origin, many at 0.5 to 0.95 to each other: the classes of all pairs compared."""
    draw = np.random.default_rng(12)
    words = prose(77, 150)
    rows = []
    for i in range(600):
        places = draw.choice(150, int(draw.integers(1, 9)), replace=False)
        rows.append((i, " ".join(f"n{i}-{p}" if p in places else w for p, w in enumerate(words))))
    sets = [set(bags(t)) for _, t in rows]
    label = list(range(600))

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    spread = []
    for i in range(600):
        for j in range(i):
            both = len(sets[i] & sets[j])
            spread.append(both / (len(sets[i]) + len(sets[j]) - both))
            if spread[-1] >= 0.8:
                low, high = sorted((find(i), find(j)))
                label[high] = low
    assert min(spread) < 0.55 and max(spread) > 0.9
    assert sum(0.7 < x < 0.8 for x in spread) > 10_000 and len({find(k) for k in range(600)}) > 100
    found = near.near_classes(documents(*rows)).collect()
    assert {r.doc_id: r.class_id for r in found} == {k: find(k) for k in range(600)}
