"""Every stage of the pipeline, on planted copies, passages and bad documents, against plain Python."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe

import corpus_pipeline
from feira.llm import quality
from feira.llm.queries import RANKS, table
from test_mixing import brute_targets
from test_near import brute as near_brute

STAGES = dict(corpus_pipeline.STAGES)
COMMON = "the of and to in is that it was for on are with as be by at".split()


def corpus(seed=3):
    """(doc_id, text, source): prose, and what each stage is there for."""
    draw = random.Random(seed)
    known = [f"{a}{b}{c}" for a in ("lo", "ta", "mi", "re") for b in ("ner", "sol", "vik", "dan") for c in ("a", "es", "um", "ing")]

    def prose(n):
        return [draw.choice(COMMON) if draw.random() < 0.45 else draw.choice(known) + draw.choice("bdfgklmnprst") for _ in range(n)]

    def said(words):
        return ". ".join(" ".join(words[i : i + 12]).capitalize() for i in range(0, len(words), 12)) + "."

    plain = [prose(draw.randrange(80, 300)) for _ in range(60)]
    texts = [said(p) for p in plain]
    copies = [texts[i] for i in (3, 3, 9, 17)]
    near = [texts[i].replace("the", "xthe", 1) for i in (4, 9, 21, 22, 23)] + [texts[5] + " One more."]
    passage = said(prose(75))
    passages = [f"{said(prose(90))} {passage} {said(prose(60))}" for _ in range(4)] + [passage]
    bad = ["too short", "", "ha " * 200, "# $ % | " * 60, "SHOUT LOUD NOW " * 40, said(["the"] * 90), "\n".join(["one line again"] * 60)]
    every = texts + copies + near + passages + bad
    draw.shuffle(every)
    sources = ["a", "b", "c", "d"]
    return [(i * 3 % 101 if len(every) <= 101 else i, t, sources[0] if i % 3 == 0 else draw.choice(sources)) for i, t in enumerate(every)]


def python_quality(docs, rows):
    """By the rules as SQL in another engine."""
    with duckdb.connect() as engine:
        engine.register("documents", docs.toArrow())
        result = engine.sql(quality.ORACLE)
        kept = {r[result.columns.index("doc_id")] for r in result.fetchall() if r[result.columns.index("kept")]}
    return [r for r in rows if r[0] in kept]


def python_near(rows):
    label = near_brute([(k, t) for k, t, _ in rows])
    return [r for r in rows if label[r[0]] == r[0]]


def python_substrings(rows, width=50):
    words = {k: t.split() for k, t, _ in rows}
    first = {}
    for k in sorted(words):
        for i in range(len(words[k]) - width + 1):
            first.setdefault(tuple(words[k][i : i + width]), k)
    result = []
    for k, text, source in rows:
        gone = set()
        for i in range(len(words[k]) - width + 1):
            if first[tuple(words[k][i : i + width])] < k:
                gone.update(range(i, i + width))
        left = [w for i, w in enumerate(words[k]) if i not in gone]
        if left:
            result.append((k, " ".join(left) if gone else text, source))
    return result


def collected(df):
    return sorted((r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect())


def test_every_stage(spark, documents):
    rows = corpus()
    docs = documents(*rows)

    kept = STAGES["quality_rules"](spark, docs, "")
    expected = python_quality(docs, rows)
    assert kept.columns == docs.columns and collected(kept) == sorted(expected)
    # What is planted to go goes; nearly all prose stays.
    assert not {t for _, t, _ in expected} & {"too short", "", "ha " * 200} and len(expected) > 0.9 * (len(rows) - 7)

    single = STAGES["near_dedup"](spark, documents(*expected), "")
    unique = python_near(expected)
    assert single.columns == docs.columns and collected(single) == sorted(unique)
    assert len(expected) - len(unique) >= 10

    trimmed = STAGES["substring_dedup"](spark, documents(*unique), "")
    shorter = python_substrings(unique)
    assert trimmed.columns == docs.columns and collected(trimmed) == sorted(shorter)
    assert sum(a != b for a, b in zip(sorted(shorter), sorted(unique))) >= 3

    mixed = STAGES["source_mix"](spark, documents(*shorter), "")
    copies = Counter(collected(mixed))
    assert mixed.columns == docs.columns and set(copies) <= set(shorter) and max(copies.values()) <= 3
    size = lambda t: len(t.split())
    sizes = Counter()
    for _, text, source in shorter:
        sizes[source] += size(text)
    for source, target in brute_targets(sizes).items():
        taken = sum(n * size(t) for (_, t, s), n in copies.items() if s == source)
        assert abs(taken - target) <= 100, source

    encoded = STAGES["byte_bpe"](spark, documents(*copies.elements()), "").collect()
    library = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path(RANKS)), special_tokens={}
    )
    assert sorted((r.doc_id, list(r.ids), r.decoded) for r in encoded) == sorted(
        (k, library.encode_ordinary(t), t) for k, t, _ in copies.elements()
    )


def test_run_is_the_stages_one_after_the_other(spark, documents, tmp_path):
    rows = corpus(seed=8)
    documents(*rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path))
    docs = table(spark, str(tmp_path), "documents")
    left = python_substrings(python_near(python_quality(docs, rows)))
    texts = {k: t for k, t, _ in left}
    got = found.collect()
    assert {r.doc_id for r in got} <= set(texts) and all(r.decoded == texts[r.doc_id] for r in got)
    # Sources that are cut lose documents; no others do.
    assert len({r.doc_id for r in got}) > 0.4 * len(texts)


@pytest.mark.parametrize("empty", [True, False])
def test_awkward_tables(spark, documents, tmp_path, empty):
    """No rows; NULL ids, texts and sources, repeated rows and columns named like results."""
    prose = corpus()[7][1]
    rows = [(None, prose, "a"), (1, None, None), (2, "", "a"), (3, prose, None), (3, prose, None), (4, prose + " and more.", "b"), (None, None, None)]
    docs = documents(*rows)
    (docs.limit(0) if empty else docs).write.parquet(str(tmp_path / "documents.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    if empty:
        assert found == []
        return
    # Of the copies under ids one stays; those without an id are not compared. The rest has no words.
    assert {r.doc_id for r in found} <= {None, 3} and found and {r.decoded for r in found} == {prose}
