from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest

from feira.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree string, pos int"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def coded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves):
    """The last node, and per leaf its (run, slot) on each level."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    paths = []
    for i in range(len(leaves)):
        path = []
        for nodes in levels[:-1]:
            path.append((nodes[i - i % 3 : i - i % 3 + 3], i % 3))
            i //= 3
        paths.append(path)
    return levels[-1][0], paths


def expected(rows):
    sources = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        even = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        found = text.replace("\n", "") if even and text is not None else text
        true, later = (digest(*map(coded, (doc_id, source, lang, n_chars, t))) for t in (text, found))
        sources[source].append(((doc_id is not None, doc_id or 0, true), doc_id, true, later))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(sources[s])]) for s in order}
    root, upper = tree([trees[s][0] for s in order])
    result = []
    for s, above in zip(order, upper):
        for (_, doc_id, true, later), path in zip(sorted(sources[s]), trees[s][1]):
            proof, fold = "", later
            for run, slot in path + above:
                proof += "".join(run[:slot] + run[slot + 1 :])
                fold = digest(*run[:slot], fold, *run[slot + 1 :])
            result.append((doc_id, true, trees[s][0], root, digest(proof), fold, fold == root))
    return sorted(result, key=repr)


def case(n, sources, more=()):
    rows = [(i, f"a\nb {i}", "e", f"s{i % sources}" if i % sources else None, 3) for i in range(n)]
    return [*rows, *more]


AWKWARD = [(None, None, None, None, None)] * 2 + [(1, "q\n", "é", "s1", 1)] * 4 + [(7, "", "", "", 0), (8, "x" * 50_000, "e", "Ä", 1)]


@pytest.mark.parametrize(
    "rows", [case(0, 1), case(1, 1), case(2, 1), case(4, 1), case(3, 3), case(82, 1), case(260, 2, AWKWARD), case(90, 30)]
)
def test_manifest_equals_brute_force(spark, rows):
    # Columns named like those of the operator do not disturb it.
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    got = sorted(map(tuple, merkle.manifest(df).collect()), key=repr)
    assert got == (expected(rows) if rows else [])
    assert sum(r[-1] for r in got) < len(got) or len(rows) < 10


def test_sql_agrees(spark):
    rows = case(100, 4, AWKWARD)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    with duckdb.connect() as engine:
        engine.register("documents", df.toArrow())
        assert sorted(engine.sql(merkle.ORACLE).fetchall(), key=repr) == expected(rows)


def test_begins_joined_by_key(spark, monkeypatch):
    monkeypatch.setattr(merkle, "FEW", 0)
    rows = case(100, 4, AWKWARD)
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    assert sorted(map(tuple, merkle.manifest(df).collect()), key=repr) == expected(rows)


def test_other_changes_are_found(spark):
    rows = case(30, 2)
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    same = merkle.manifest(df, lambda doc_id, text: text)
    assert same.filter("NOT verified").isEmpty()
    other = merkle.manifest(df, lambda doc_id, text: merkle.F.when(doc_id == 5, "other").otherwise(text))
    assert [r.doc_id for r in other.filter("NOT verified").collect()] == [5]
