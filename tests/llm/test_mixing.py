from __future__ import annotations

import pytest

from conftest_llm import LONG
from feira.llm import mixing


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        share = {s: most * sizes[s] if s in full else rest * weight[s] / sum(weight[o] for o in order if o not in full) for s in order}
        over = {s for s in order if s not in full and share[s] > most * sizes[s] * (1 + 1e-12)}
        if not over:
            return share
        full |= over


def corpus():
    rows = []
    for source, n, step in (("b", 400, 7), ("a", 120, 31), (None, 90, 13), ("é", 60, 50), ("tiny", 3, 5), ("z", 900, 3)):
        rows += [(len(rows) + i, " ".join(["w"] * (1 + i * step % 97)), source) for i in range(n)]
    return rows


def test_targets_and_rounding(documents):
    rows = corpus()
    found = mixing.mixed(documents(*rows)).collect()
    sizes, taken, target = {}, {}, {}
    for r in found:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3 and r.source_size == sum(
            len(t.split()) for _, t, s in rows if s == r.source
        )
    for source, share in brute_targets(sizes).items():
        assert target[source] == pytest.approx(share, rel=1e-9)
        assert abs(taken[source] - share) <= max(3, 0.01 * share), source


def test_rates_are_an_exponential_tilt(documents):
    """Each source's rates solve the dual: exp(tilt * size), cut at 3, and meet the target."""
    import math

    found = mixing.mixed(documents(*corpus())).filter("source IN ('a', 'b', 'z')").collect()
    for source in "abz":
        own = [r for r in found if r.source == source]
        assert sum(r.rate * r.size for r in own) == pytest.approx(own[0].target, rel=1e-6)
        slopes = {round(math.log(r.rate) / r.size, 9) for r in own if r.rate < 2.999}
        assert len(slopes) <= 2 and max(slopes) - min(slopes) < 1e-8


def test_reruns_agree(documents):
    first, second = [sorted(map(tuple, mixing.mixed(documents(*corpus())).select("doc_id", "copies").collect())) for _ in range(2)]
    assert first == second
    again = documents(*corpus()).repartition(7)
    assert sorted(map(tuple, mixing.mixed(again).select("doc_id", "copies").collect())) == first


def test_awkward_rows(documents):
    rows = [(None, "a b", None), (1, None, "s"), (2, "", "s"), (3, LONG, "s"), (4, "x", "t"), (4, "x", "t"), (5, "  ", None)]
    found = mixing.mixed(documents(*rows)).collect()
    assert len(found) == len(rows) and all(0 <= r.copies <= 3 for r in found)
    assert {r.size for r in found} == {0, 1, 2, 30_000}
    copies = mixing.expanded(documents(*rows))
    assert copies.columns == documents(*rows).columns and copies.count() == sum(r.copies for r in found)
    assert mixing.mixed(documents((1, "x")).filter("false")).count() == 0
    nothing = mixing.mixed(documents((1, None), (2, ""))).collect()
    assert [(r.size, r.target, r.taken) for r in nothing] == [(0, 0.0, 0)] * 2


def test_no_python(documents):
    plan = mixing.mixed(documents(*corpus()[:50]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
