from __future__ import annotations

import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from feira.llm import toxicity
from feira.llm.queries import table

INSULTS = ("blockhead", "nitwit", "dimwit", "halfwit", "buffoon")


def kernel(a, b):
    """The definition: shared subsequences of three symbols, each less for what it skips."""

    def weights(word):
        symbols = toxicity.encoded([word])[0]
        found = Counter()
        for i, j, k in combinations(range(len(symbols)), 3):
            found[symbols[i], symbols[j], symbols[k]] += toxicity.DECAY ** (k - i - 2)
        return found

    x, y = weights(a), weights(b)
    return sum(x[s] * y[s] for s in x) / np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def corpus(n=600, seed=5):
    """Sentences of syllables, every eighth text with insults."""
    pick = random.Random(seed)
    syllables = ["ka", "to", "mi", "re", "lun", "wit", "head", "bor", "oon", "sel"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(pick.choices(syllables, k=pick.randint(1, 3))) for _ in range(pick.randint(8, 60))]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(3):
                words.insert(pick.randrange(len(words)), pick.choice(INSULTS))
        rows.append((i, " ".join(words[:6]) + ". " + " ".join(words[6:])))
        labels.append((i, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def learned(spark, documents):
    rows, labels = corpus()
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    return toxicity.learn(documents(*rows), given)


def test_kernel_is_the_definition():
    words = ["idiot", "idioot", "id-iot", "a", "ab", "banana", "bananas", "strasse", "straße", "яблоко", "x" * 24]
    found = toxicity.Landmarks(words).kernel(words)
    wanted = [[kernel(a, b) for b in words] for a in words]
    assert np.allclose(found, wanted, atol=1e-5)
    assert found[0, 1] > 0.7 > found[0, 5]


def test_table_gives_the_margins_of_the_machine():
    signs, clean = [(w, 3) for w in INSULTS], ["house", "wit", "head", "balloon", "witness", "block", "fool"]
    model = toxicity.fitted(signs, clean)
    judge = toxicity.Judge(model)
    words = [w for w, _ in signs] + clean
    margins = [next(judge.look([w]))[1] for w in words]
    assert min(margins[: len(signs)]) > 0 > max(margins[len(signs) :])


def test_machine_is_at_its_minimum():
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=(200, 5)), np.ones(200)])
    y = np.sign(x[:, 0] + 0.3 * rng.normal(size=200))
    weight = np.full(200, 1 / 200)
    w = toxicity.support_vectors(x, y, weight, 1e-2)
    inside = np.maximum(0, 1 - y * (x @ w))
    gradient = np.r_[np.full(5, 1e-2), 1e-9] * w - x.T @ (weight * inside * y)
    assert np.abs(gradient).max() < 1e-4


def test_insults_are_found_plain_gapped_and_with_inserted_characters(documents, learned):
    said = {
        "plain": "kato reka nitwit dimwit lunmi",
        "points": "kato reka n.i.t.w.i.t dim-wit lunmi",
        "apart": "kato reka n i t w i t d i m w i t and buffoon lunmi",
        "inserted": "kato reka nitwiit bloockhead buffooon dimmwit lunmi",
        "upper": "KATO REKA NITWIT!! BUFFOON?! lunmi",
        "clean": "kato reka wit head oon lunmi sel borwit",
        "empty": "",
    }
    rows = list(enumerate(said.values()))
    found = toxicity.scored(documents(*rows, (98, None), (99, said["plain"] + " selka" * 20_000)), learned)
    got = {r.doc_id: r for r in found.collect()}
    assert [got[i].predicted for i in range(len(said))] == [1, 1, 1, 1, 1, 0, 0]
    assert got[6].score == got[98].score == 0 and got[99].score < got[0].score
    assert "nitwit" in got[0].toxic_sentence or "dimwit" in got[0].toxic_sentence
    assert got[5].toxic_sentence is None
    assert found.columns[-3:] == ["score", "predicted", "toxic_sentence"] and "a b" in found.columns


def test_held_out_texts(spark, documents):
    rows, labels = corpus()
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    result = {r.doc_id: r for r in toxicity.toxicity(documents(*rows), given).collect()}
    assert all(result[i].held_out == held(i) for i, _ in rows)
    assert all(result[i].predicted == toxic for i, toxic in labels)
    # Their labels are not looked at: turned around, all scores stay.
    turned = [(i, 1 - toxic if held(i) else toxic) for i, toxic in labels]
    again = toxicity.toxicity(documents(*rows), spark.createDataFrame(turned, "doc_id long, toxic int"))
    assert {r.doc_id: r.score for r in again.collect()} == {i: r.score for i, r in result.items()}


def test_given_labels_held_out(spark):
    """At sf0.01 half the toxic labels stand on texts without any repeated sign; the others are found."""
    docs, labels = (table(spark, "/root/testdata/sf0.01", name) for name in ("documents", "labels"))
    judged = toxicity.toxicity(docs, labels).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    english = judged.filter("held_out AND lang = 'en'").collect()
    assert all(r.predicted == 0 for r in english if r.toxic == 0)
    assert sum(r.predicted for r in english if r.toxic == 1) >= 0.8 * sum(r.toxic for r in english)


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, 1), (2, 1)], [(1, None), (None, 1)]])
def test_without_a_sign_every_text_scores_the_share(spark, documents, labels):
    docs = documents((1, "one text"), (2, "another text"), (2, "another text"), (None, None), (3, ""))
    result = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    known = [t for i, t in labels if i is not None and t is not None and not held(i)]
    assert len(result) == 5 and {r.score for r in result} == {float(sum(known) / len(known)) if known else 0.0}


def test_windows_cover_long_words():
    word = "".join(chr(0x4E00 + i) for i in range(101))
    parts = toxicity.windows(word)
    assert all(len(p) <= toxicity.WINDOW for p in parts) and word.startswith(parts[0]) and word.endswith(parts[-1])
    assert all(any(word[i : i + 12] in p for p in parts) for i in range(len(word) - 12))
