from __future__ import annotations

from feira.operators.constraints import (
    constraint_report,
    foreign_key_violations,
    orphan_rows,
    primary_key_violations,
    width_violations,
)
from feira.specs import CLEAN, ForeignKey, TableSpec, char, parents_first, varchar

from conftest import values


def test_primary_key(rows):
    df = rows("a int, b string", (1, "x"), (1, "x"), (2, None), (3, "y"), (3, "z"))
    assert values(primary_key_violations(df, ["a", "b"])) == [(1, "x", 2), (2, None, 1)]


def test_foreign_key_ignores_incomplete_keys(rows):
    child = rows("a int, b int, v string", (1, 1, "in"), (1, 9, "out"), (1, 9, "out2"), (1, None, "open"))
    parent = rows("x int, y int", (1, 1), (1, 1))
    assert values(foreign_key_violations(child, ["a", "b"], parent, ["x", "y"])) == [(1, 9, 2)]
    assert values(orphan_rows(child, ["a", "b"], parent, ["x", "y"]), "v") == [("out",), ("out2",)]


def test_width_counts_no_trailing_spaces(rows):
    df = rows("s string, t string", ("abc", "ab  "), ("abcd", "abc"), ("abc   ", None), ("äöü", "é"))
    found = width_violations(df, {"s": 3, "t": 2})
    assert [(r.s, r.too_wide) for r in found.collect()] == [("abcd", ["s", "t"])]


def test_report(rows):
    parent = TableSpec("parent", (char("id", 2),), primary_key=("id",))
    child = TableSpec(
        "child",
        (char("id", 2), char("ref", 2), varchar("note", 3)),
        primary_key=("id",),
        foreign_keys=(ForeignKey(("ref",), "parent", ("id",)),),
    )
    other = TableSpec(
        "other",
        (char("id", 2), char("p", 2)),
        primary_key=("id",),
        foreign_keys=(ForeignKey(("p",), "parent", ("id",)),),
    )
    tables = {
        "parent": rows("id string", ("a",), ("a",), ("b",)),
        "child": rows(
            "id string, ref string, note string",
            ("1", "a", "abc"), ("2", "z", "abcd"), ("2", "z", "ab "), (None, None, "abc  "),
        ),
        "other": rows("id string, p string", ("1", "z"), ("2", "b")),
    }
    found = {r.constraint_name: r.violations for r in constraint_report(tables, (parent, child, other)).collect()}
    assert found == {
        "parent_key_not_null": 0, "parent_id_width": 0, "parent_key_unique": 1,
        "child_key_not_null": 1, "child_id_width": 0, "child_ref_width": 0, "child_note_width": 1,
        "child_key_unique": 1, "child_parent_reference": 2,
        "other_key_not_null": 0, "other_id_width": 0, "other_p_width": 0,
        "other_key_unique": 0, "other_parent_reference": 1,
    }


def test_empty_tables_report_zero(rows):
    spec = TableSpec("t", (char("id", 2),), primary_key=("id",))
    assert {r.violations for r in constraint_report({"t": rows("id string")}, (spec,)).collect()} == {0}


def test_parents_come_first():
    seen = set()
    for group in parents_first(CLEAN):
        for spec in group:
            assert {fk.parent for fk in spec.foreign_keys} <= seen
        seen |= {spec.name for spec in group}
    assert len(seen) == 10


def test_declared_keys_references_and_widths():
    """The contract of the clean tables as plain values, apart from the code that declares them."""
    from feira.specs import CLEAN

    keys = {spec.name: ",".join(spec.primary_key) for spec in CLEAN}
    assert keys == {
        "customers": "customer_id",
        "geolocation": "geolocation_id",
        "order_items": "order_id,order_item_id",
        "order_payments": "order_id,payment_sequential",
        "order_reviews": "order_id,review_id",
        "orders": "order_id",
        "product_category_name_translation": "product_category_name",
        "products": "product_id",
        "sellers": "seller_id",
        "zip": "zip_code_prefix,zip_city,zip_state",
    }
    references = {(s.name, ",".join(fk.columns), fk.parent) for s in CLEAN for fk in s.foreign_keys}
    assert references == {
        ("customers", "customer_zip_code_prefix,customer_city,customer_state", "zip"),
        ("geolocation", "geolocation_zip_code_prefix,geolocation_city,geolocation_state", "zip"),
        ("order_items", "order_id", "orders"),
        ("order_items", "product_id", "products"),
        ("order_items", "seller_id", "sellers"),
        ("order_payments", "order_id", "orders"),
        ("order_reviews", "order_id", "orders"),
        ("orders", "customer_id", "customers"),
        ("products", "product_category_name", "product_category_name_translation"),
        ("sellers", "seller_zip_code_prefix,seller_city,seller_state", "zip"),
    }
    widths = {s.name: " ".join(str(w) for w in s.widths.values()) for s in CLEAN}
    assert widths == {
        "customers": "32 32 5 40 2",
        "geolocation": "5 40 2",
        "order_items": "32 32 32",
        "order_payments": "32 20",
        "order_reviews": "32 32 255 255",
        "orders": "32 32 11",
        "product_category_name_translation": "50 50",
        "products": "32 50",
        "sellers": "32 5 40 2",
        "zip": "5 40 2",
    }
