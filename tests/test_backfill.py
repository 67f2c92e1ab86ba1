from __future__ import annotations

from functools import reduce

import pytest

from feira.operators.backfill import backfill, missing_keys, reference_counts, zip_dimension
from feira.specs import ORDER_ITEMS

from conftest import values

PARENT = "id string, name string, size int"


def test_one_stub_per_missing_key(rows):
    parent = rows(PARENT, ("a", "A", 1), ("b", "B", 2))
    child = rows("ref string", ("a",), (None,), ("c",), ("c",))
    found = backfill(parent, ["id"], [(child, ["ref"])])
    assert found.schema.simpleString() == parent.schema.simpleString()
    assert values(found) == [("a", "A", 1), ("b", "B", 2), ("c", None, None)]


def test_second_run_adds_nothing(rows):
    parent = rows(PARENT, ("a", "A", 1))
    child = rows("ref string", ("x",), ("y",))
    once = backfill(parent, ["id"], [(child, ["ref"])])
    assert missing_keys(once, ["id"], [(child, ["ref"])]).count() == 0
    assert values(backfill(once, ["id"], [(child, ["ref"])])) == values(once)


def test_children_together_equal_children_in_turn(rows):
    parent = rows(PARENT, *[(str(i), "n", i) for i in range(0, 40, 3)])
    children = [
        rows("ref string", *[(str(i % 50) if i % 7 else None,) for i in range(k, 200, 2)])
        for k in range(3)
    ]
    together = backfill(parent, ["id"], [(c, ["ref"]) for c in children])
    in_turn = reduce(lambda p, c: backfill(p, ["id"], [(c, ["ref"])]), children, parent)
    assert values(together) == values(in_turn)


def test_hot_key_and_repeated_parent(spark):
    child = spark.range(30_000).selectExpr("if(id % 3 = 0, -1, id % 100) AS ref")
    parent = spark.range(20_000).selectExpr("if(id % 3 = 0, 7, id % 50) AS id", "1 AS v")
    found = values(missing_keys(parent, ["id"], [(child, ["ref"])]))
    assert found == sorted([(k,) for k in range(50, 100)] + [(-1,)], key=repr)


@pytest.mark.parametrize("missing", ["zip", "city", "state"])
def test_incomplete_place_of_a_child_is_left_out(rows, missing):
    place = {"zip": "1", "city": "x", "state": "SP"} | {missing: None}
    places = rows(
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string",
        ("2", 1.0, 1.0, "y", "RJ"),
        ("2", 1.5, 1.0, "y", "RJ"),
        (None, 1.0, 1.0, "y", "RJ"),
    )
    customers = rows(
        "customer_zip_code_prefix string, customer_city string, customer_state string",
        tuple(place.values()),
        ("3", "z", "SP"),
    )
    sellers = rows(
        "seller_zip_code_prefix string, seller_city string, seller_state string",
        ("3", "z", "SP"),
        ("2", "y", "RJ"),
        ("4", "w", "BA"),
    )
    assert values(zip_dimension(places, customers, sellers)) == [
        ("2", "y", "RJ"), ("3", "z", "SP"), ("4", "w", "BA"), (None, "y", "RJ"),
    ]


def test_key_counts_run_through_compiled_code_only(spark):
    rows = [("o1", 1, "p1", None), ("o1", 2, None, "s1"), (None, 3, "p1", "s1")]
    items = spark.createDataFrame(rows, "order_id string, order_item_id smallint, product_id string, seller_id string")
    counts = reference_counts(items, ORDER_ITEMS)
    assert "lambda" not in counts._jdf.queryExecution().optimizedPlan().toString()
    found = sorted((r.reference.split("_")[2], r["keys"], r.child_rows) for r in counts.collect())
    assert found == [("orders", ["o1"], 2), ("products", ["p1"], 2), ("sellers", ["s1"], 2)]
