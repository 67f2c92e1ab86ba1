from __future__ import annotations

import re
from collections import Counter

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st

from feira.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    """The base measures, word by word."""
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {
        i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)
    }
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


TEXTS = st.text(alphabet="ab #|\n\t é \U0001f600", max_size=60) | st.lists(
    st.sampled_from(["the", "cat", "sat", "a\nb", "#"]), max_size=40
).map(" ".join)


# Not shrunk: each example is a Spark job.
@settings(max_examples=4, deadline=None, phases=[Phase.generate])
@given(texts=st.lists(TEXTS, min_size=12, max_size=25))
def test_base_measures(documents, texts):
    rows = [(i, text) for i, text in enumerate([None, "", " \n", *texts])]
    found = {r.doc_id: r.asDict() for r in quality.judged(documents(*rows)).collect()}
    for i, text in rows:
        expected = brute(text)
        assert {k: found[i][k] for k in expected} == expected, repr(text)
        failed = expected["n_words"] < 50 or 100 * expected["n_repeat_words"] > 50 * expected["n_words"]
        assert found[i]["base_failed"] is failed and not (failed and found[i]["kept"])


def clean_text(n=60):
    return " ".join(("the" if i % 5 == 0 else f"word{i}") for i in range(n))


@pytest.mark.parametrize(
    ("text", "kept"),
    [
        (clean_text(), True),
        (clean_text(49), False),
        (clean_text().replace("word", "# word"), False),
        (clean_text().upper(), False),
        (" ".join(f"word{i}" for i in range(60)), False),
        (" ".join(f"{'verylong' * 4}{i}" if i % 5 else "the" for i in range(60)), False),
        ("\n".join([clean_text(10)] * 6), False),
        (clean_text(20_000), True),
    ],
)
def test_verdicts(documents, text, kept):
    docs = documents((1, text), (2, None), (1, text))
    assert [(r.doc_id, r.kept) for r in quality.judged(docs).orderBy("doc_id").collect()] == [
        (1, kept), (1, kept), (2, False),
    ]
    left = quality.filter_quality(docs)
    assert left.columns == docs.columns and left.count() == 2 * kept


def test_empty_table_and_columns(documents):
    docs = documents((1, "x")).filter("false")
    found = quality.judged(docs)
    assert found.count() == 0 and found.columns.count("n_words") == 1 and "a b" in found.columns


def test_no_python_and_no_shuffle(documents):
    text = quality.judged(documents((1, "x")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Exchange" not in text
