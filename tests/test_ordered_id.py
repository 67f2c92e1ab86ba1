from __future__ import annotations

import random

import pytest

from feira.operators.ordered_id import add_ordered, first_ids

SCHEMA = "a string, b long"


def check(spark, present, new, gap):
    """Ids are in order and distinct; returns the rows and how many present ones moved."""
    old = {tuple(r)[1:]: r[0] for r in present.collect()}
    table = add_ordered(present, spark.createDataFrame(new, SCHEMA), ["a", "b"], "id", gap)
    found = sorted((r.a, r.b, r.id, r.moved) for r in table.collect())
    assert [r[:2] for r in found] == sorted([*old, *new])
    ids = [r[2] for r in found]
    assert all(x < y for x, y in zip([0, *ids], ids))
    for a, b, now, moved in found:
        assert moved == (old.get((a, b), now) != now)
    return spark.createDataFrame([(i, a, b) for a, b, i, _ in found], f"id long, {SCHEMA}"), found


def test_ten_appends_keep_the_order(spark):
    draw = random.Random(4)
    every = [(f"{draw.randrange(40):02d}", n) for n in range(330)]
    present = first_ids(spark.createDataFrame(every[:30], SCHEMA), ["a", "b"], "id", 8)
    assert [r.id for r in present.orderBy("a", "b").collect()] == [8 * i for i in range(1, 31)]
    shares = []
    for i in range(10):
        present, found = check(spark, present, every[30 + 30 * i : 60 + 30 * i], 8)
        shares.append(sum(r[3] for r in found) / len(found))
    # Gaps of 8 fill up, so some have to be spread anew, but never the whole table.
    assert any(shares) and max(shares) < 1


def test_rows_outside_the_block_keep_their_ids(spark):
    present = first_ids(spark.createDataFrame([(f"{i:04d}", 0) for i in range(400)], SCHEMA), ["a", "b"], "id", 16)
    table, found = check(spark, present, [("0200", n) for n in range(1, 40)], 16)
    moved = [r for r in found if r[3]]
    # 39 rows into a gap of 16: a block of 256 ids with 16 rows holds them.
    assert 0 < len(moved) <= 16 and all("0180" < r[0] < "0220" for r in moved)
    # Without need nothing moves.
    again, found = check(spark, table, [("0100", 5), ("0399", 1), ("9999", 1)], 16)
    assert not any(r[3] for r in found)


@pytest.mark.parametrize("gap", [1, 2, 1024])
def test_front_end_and_one_gap_that_takes_a_third(spark, gap):
    present = first_ids(spark.createDataFrame([("m", n) for n in range(50)], SCHEMA), ["a", "b"], "id", gap)
    table, _ = check(spark, present, [("a", n) for n in range(60)], gap)
    table, _ = check(spark, table, [("z", n) for n in range(60)], gap)
    table, _ = check(spark, table, [("l", n) for n in range(150)], gap)
    check(spark, table, [], gap)


def test_no_present_rows(spark):
    empty = spark.createDataFrame([], f"id long, {SCHEMA}")
    _, found = check(spark, empty, [("b", 2), ("a", 1), ("b", 1)], 16)
    assert [r[2] for r in found] == [16, 32, 48]
    assert add_ordered(empty, spark.createDataFrame([], SCHEMA), ["a", "b"], "id").count() == 0


def test_null_parts_of_the_key_come_first(spark):
    present = first_ids(spark.createDataFrame([("a", 1), (None, 1)], SCHEMA), ["a", "b"], "id")
    table = add_ordered(present, spark.createDataFrame([(None, 2), ("a", None), (None, None)], SCHEMA), ["a", "b"], "id")
    rows = [(r.a, r.b) for r in table.orderBy("id").collect()]
    assert rows == [(None, None), (None, 1), (None, 2), ("a", None), ("a", 1)]


def test_rows_are_joined_as_often_whatever_blocks_they_move_in(spark):
    """Once with the ranges and once with the blocks to move, which are put together in a third join."""
    present = first_ids(spark.createDataFrame([("m", n) for n in range(200)], SCHEMA), ["a", "b"], "id", 1)
    for new in (40, 400, 4000):
        rows = spark.createDataFrame([("l", n) for n in range(new)] + [("m", -1 - n) for n in range(9)], SCHEMA)
        table = add_ordered(present, rows, ["a", "b"], "id", 1)
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == 3, plan
        # Behind a first gap without room: all rows in order, with positive ids.
        found = [(r.a, r.b) for r in table.filter("id > 0").orderBy("id").collect()]
        assert found == sorted(found) and len(set(found)) == 209 + new
