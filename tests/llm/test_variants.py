from __future__ import annotations

import re
import zlib
from collections import Counter

import duckdb
import pytest
from conftest_llm import prose

from feira.llm import variants


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def expected(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    forms, n_near = {}, {}
    for w in counts:
        others = sorted((-counts[o], o) for o in counts if near(w, o))
        n_near[w] = len(others)
        forms[w] = others[0][1] if others and -others[0][0] >= 5 * counts[w] else None

    def root(w):
        return w if forms[w] is None else root(forms[w])

    return sorted(
        ((w, forms[w], root(w), n, n_near[w], counts.get(forms[w])) for w, n in counts.items()), key=repr
    )


def rows():
    """Chains of forms, equal counts, repeated letters, letters beyond ASCII, one word that is most of the text."""
    times = {
        "balloon": 3000, "baloon": 400, "bbaloon": 60, "ballooon": 7, "bxlloon": 5, "balloons": 600, "ballon": 5,
        "aaaaaa": 50, "aaaaaaa": 6, "aaaaab": 50, "aaaaac": 10, "straße": 30, "strase": 30, "strafe": 5, "Élevée": 25,
        "élevée": 5, "ÉLEVée": 5, "short": 90, "shorts": 9, "rarely": 4, "rarelys": 20, "naïveté": 40, "naïvete": 8,
    }
    words = [w for w, n in times.items() for _ in range(n)]
    texts = [(i, " ".join(words[i::40])) for i in range(40)]
    many = [(100 + i, "-".join(prose(i % 9, 400)).replace("w", "word").translate(str.maketrans("0123456789", "abcdefghij")))
            for i in range(60)]
    return texts + many + [(1, None), (2, ""), (None, "Balloon, balloon!"), (3, "balloon×balloon \x00baloon")] + texts[:1]


def test_variants_equal_brute_force(documents):
    got = sorted((tuple(r) for r in variants.variants(documents(*rows())).collect()), key=repr)
    want = expected(rows())
    assert got == want
    by_word = {r[0]: r for r in want}
    assert by_word["bbaloon"][1:3] == ("baloon", "balloon") and by_word["strafe"][1] == "strase"
    assert sum(r[0].startswith("word") for r in want) > 200


def test_sql_agrees(documents):
    with duckdb.connect() as engine:
        engine.register("documents", documents(*rows()).toArrow())
        assert sorted(engine.sql(variants.ORACLE).fetchall(), key=repr) == expected(rows())


def test_long_text_and_full_memory(documents, monkeypatch):
    monkeypatch.setattr(variants, "PIECE", 50)
    monkeypatch.setattr(variants, "REMEMBERED", 3)
    assert b"".join(variants.pieces(b"ab cd" * 99)) == b"ab cd" * 99
    got = sorted((tuple(r) for r in variants.variants(documents(*rows())).collect()), key=repr)
    assert got == expected(rows())


@pytest.mark.parametrize("texts", [[], [(1, None)], [(1, "few words")]])
def test_no_words(documents, texts):
    df = documents(*texts) if texts else documents((1, "")).limit(0)
    assert variants.variants(df).collect() == []
