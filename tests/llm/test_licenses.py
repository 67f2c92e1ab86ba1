from __future__ import annotations

import re
import time

import pyarrow.parquet as pq
import pytest
from hypothesis import given
from hypothesis import strategies as st

from conftest_llm import LONG, prose
from feira.llm import licenses

MIT = licenses.TEMPLATES["MIT"]
APACHE = licenses.TEMPLATES["Apache-2.0"]
HEADER = licenses.TEMPLATES["Apache-2.0-header"]


def test_notices(documents):
    pad = " ".join(prose(1, 200))
    rows = [
        (1, f"{pad}\n{MIT}\n{pad}"), (2, MIT.upper()), (3, f"{MIT} {MIT}\n{MIT}"), (4, pad), (5, None), (6, ""),
        (7, f"{LONG} {HEADER} {LONG}"), (8, "released under " + pad + " the mit license"), (9, f"{MIT} {APACHE}"),
        (None, MIT), (9, f"{MIT} {APACHE}"), (10, "Released und the MIT License"), (11, "the license under the license"),
        (12, HEADER.replace("governing", "ruling").replace("agreed to in writing", "agreed")),
    ]
    found = licenses.licenses(documents(*rows)).collect()
    got = sorted([(r.doc_id, r.license, r.n_notices) for r in found], key=repr)
    assert got == sorted([
        (1, "MIT", 1), (2, "MIT", 1), (3, "MIT", 3), (4, None, 0), (5, None, 0), (6, None, 0),
        (7, "Apache-2.0-header", 2), (8, None, 0), (9, "Apache-2.0", 2), (None, "MIT", 1), (9, "Apache-2.0", 2),
        (10, "MIT", 1), (11, None, 0), (12, "Apache-2.0-header", 2),
    ], key=repr)
    first = next(r for r in found if r.doc_id == 1)
    assert (first.coverage, first.first_word, first.last_word) == (1.0, 200, 204)
    changed = next(r for r in found if r.doc_id == 12)
    assert 0.9 < changed.coverage < 1


def default_scanner():
    parts = licenses.TEMPLATES, licenses.COVERAGE, licenses.STRETCH, licenses.DECIDING, licenses.FOREIGN
    return licenses.Scanner(*parts)


LINES = {
    "All rights reserved.": "All-rights-reserved",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Released under the MIT License.": "MIT",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
}


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_every_license_line_of_the_tables(scale):
    texts = pq.read_table(f"/root/testdata/{scale}/documents.parquet", columns=["text"])["text"].to_pylist()
    about = re.compile("licen[cs]e|copyright|rights reserved|public domain|creative commons|proprietary", re.I)
    lines = [(text, line) for text in texts if text for line in set(text.split("\n")) if about.search(line)]
    assert {line for _, line in lines} <= LINES.keys()
    scanner = default_scanner()
    for text, line in lines:
        assert LINES[line] in {name for name, *_ in scanner.notices(text)}


OTHERS = [
    "Released under the BSD License.",
    "Licensed under CC BY 4.0.",
    "Licensed under CC BY-SA 4.0.",
    "This work is licensed under the GNU General Public License, version 2.",
    "This work is licensed under the GNU Lesser General Public License, version 3.",
    "This work is licensed under the GNU Affero General Public License, version 3.",
    "Licensed under CC BY-NC-SA 4.0.",
    "Licensed under CC BY-NC-ND 4.0.",
    "Licensed under CC BY-NC 3.0.",
    "Licensed under the Apache License, Version 1.0.",
    "Licensed under the Apache License, Version 1.1.",
    "Licensed under the Educational Community License, Version 2.0.",
    "Some rights reserved.",
    licenses.TEMPLATES["GPL-3.0-header"].replace("either version 3", "either version 2"),
    licenses.TEMPLATES["GPL-3.0-header"].replace("GNU General", "GNU Lesser General"),
    HEADER.replace("Apache License", "Educational Community License").replace("apache", "opensource"),
]


def test_other_licenses_have_no_label(documents):
    pad = " ".join(prose(3, 30))
    rows = [(i, line) for i, line in enumerate(OTHERS)] + [(i, f"{pad} {line}\n{pad}") for i, line in enumerate(OTHERS)]
    found = licenses.licenses(documents(*rows)).collect()
    assert len(found) == len(rows)
    assert [(OTHERS[r.doc_id], r.license) for r in found if r.license or r.n_notices] == []


@pytest.mark.parametrize("line", LINES)
@pytest.mark.parametrize("other", OTHERS)
def test_notice_beside_another_license(line, other):
    pad = " ".join(prose(3, 30))
    for text in (f"{other}\n{line}", f"{line}\n{other}", f"{pad} {other} {line} {pad}", f"{pad} {line} {other} {pad}"):
        assert [name for name, *_ in default_scanner().notices(text)] == [LINES[line]]


def test_deciding_phrases_may_stand_beside_changes():
    for text, name in [
        ("Licensed under CC BY-NC, version 4.0", "CC-BY-NC-4.0"),
        ("licensed under the GNU General Public License (GPL), version 3", None),
        ("this work is licensed under the GNU General Public License (GPL), version 3", "GPL-3.0"),
        ("this work is licensed under the GNU General Public License, version 2 or version 3", "GPL-3.0"),
        ("All rights are reserved", "All-rights-reserved"),
        ("Licensed under the Apache License 2.0", "Apache-2.0"),
    ]:
        assert [n for n, *_ in default_scanner().notices(text)] == ([name] if name else []), text


def test_deciding_phrase_must_be_in_its_template():
    with pytest.raises(ValueError, match="does not hold 'bsd'"):
        licenses.Scanner({"MIT": MIT}, 0.8, 1.5, {"MIT": ("bsd",)})


def test_empty_table(documents):
    assert licenses.licenses(documents((1, "x")).filter("false")).count() == 0


@given(st.lists(st.sampled_from("abcdefg"), max_size=14), st.lists(st.sampled_from("abcdefg"), max_size=14))
def test_alignment_pairs_equal_words_in_order(a, b):
    pairs = licenses.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    if len(set(a)) == len(a) and len(set(b)) == len(b):
        # All words are anchors then, so it is a longest common subsequence.
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + (x == y))
        assert len(pairs) == best[-1][-1]


@pytest.mark.parametrize(
    ("a", "b", "n"),
    [("xabcy", "abc", 3), ("a1b1c", "a2b2c", 3), ("thethe", "the", 3), ("abab", "abab", 4), ("xyz", "abc", 0)],
)
def test_alignment(a, b, n):
    assert len(licenses.align(list(a), list(b))) == n


@pytest.mark.parametrize(
    "text",
    [
        "Released under the MIT-0 License.", "Not released under the MIT License.", "never licensed under CC BY-NC 4.0.",
        "This is not licensed under the Apache License, Version 2.0.", "Released under the MIT No Attribution License.",
    ],
)
def test_words_next_to_a_notice_can_turn_it(text):
    assert default_scanner().best(text) is None
    # The same words elsewhere do not.
    assert default_scanner().best("This is not 0. Released under the MIT License. No warranty.")[0] == "MIT"


def test_near_misses_are_cheap():
    """A header of another license, over and over: each of its stretches is aligned once."""
    header = licenses.TEMPLATES["GPL-3.0-header"].replace("GNU General", "GNU Lesser General")
    text = (header + "\n") * (97_000 // len(header))
    begin = time.process_time()
    assert default_scanner().best(text) is None
    assert time.process_time() - begin < 2
    found = default_scanner().best(text + licenses.TEMPLATES["GPL-3.0-header"] + "\n" + header)
    assert found[0] == "GPL-3.0-header" and found[4] == 1
