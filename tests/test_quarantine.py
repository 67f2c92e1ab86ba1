"""Rows set apart, against rounds over the references until nothing changes."""

from __future__ import annotations

from collections import Counter

import pytest

from feira.operators.quarantine import REASONS, kept_rows, marked_rows, quarantine
from feira.plans.refresh import HARMLESS, ConstraintViolation, Layers, load_clean, load_raw, refresh, rejected
from feira.specs import CLEAN, ORDERS, SELLERS, TableSpec, ForeignKey, char

from conftest import values
from test_refresh import make_feed, write_feed

TOP = TableSpec("top", (char("a", 3), char("note", 2)), ("a",))
MIDDLE = TableSpec("middle", (char("b", 3), char("a", 3)), ("b",), (ForeignKey(("a",), "top", ("a",)),))
LOW = TableSpec(
    "low", (char("c", 3), char("b", 3), char("a", 3)), ("c", "b"),
    (ForeignKey(("b",), "middle", ("b",)), ForeignKey(("a",), "top", ("a",))),
)
TABLES = {
    "top": [("a1", "x"), ("a2", "too wide"), ("a3", "x"), ("a3", "y"), (None, "x"), ("a4", "x"), ("a4", "too wide"), ("a5", "x  ")],
    "middle": [("b1", "a1"), ("b2", "a2"), ("b3", "a3"), ("b4", "a4"), ("b5", None), ("b6", "a9"), ("b1x", "a5")],
    "low": [("c1", "b1", "a1"), ("c2", "b2", "a1"), ("c3", "b3", "a3"), ("c4", "b4", None), ("c5", "b5", "a2"),
            ("c6", "b6", "a1"), ("c7", "b9", "a9"), ("c8", "b1", "a1"), ("c8", "b1", "a1"), ("c9", None, "a1")],
}


def expected():
    """(table, row, reasons) by rounds; every copy of a row by itself."""
    specs = (TOP, MIDDLE, LOW)
    rows = [(s, i, dict(zip(s.names, r))) for s in specs for i, r in enumerate(TABLES[s.name])]
    reasons = {(s.name, i): [] for s, i, _ in rows}
    for s, i, r in rows:
        if any(r[k] is None for k in s.primary_key):
            reasons[s.name, i].append(f"{s.name}_key_not_null")
        for c, n in s.widths.items():
            if r[c] is not None and len(r[c].rstrip()) > n:
                reasons[s.name, i].append(f"{s.name}_{c}_width")
    single = [(s, i, r) for s, i, r in rows if not reasons[s.name, i]]
    copies = Counter((s.name, *[r[k] for k in s.primary_key]) for s, i, r in single)
    for s, i, r in single:
        if copies[(s.name, *[r[k] for k in s.primary_key])] > 1:
            reasons[s.name, i].append(f"{s.name}_key_unique")
    while True:
        kept = {(s.name, *[r[k] for k in s.primary_key]) for s, i, r in rows if not reasons[s.name, i]}
        new = {
            (s.name, i): f"{s.name}_{fk.parent}_reference"
            for s, i, r in rows for fk in s.foreign_keys
            if all(r[c] is not None for c in fk.columns) and (fk.parent, *[r[c] for c in fk.columns]) not in kept
            and f"{s.name}_{fk.parent}_reference" not in reasons[s.name, i]
        }
        if not new:
            return sorted(((s.name, tuple(r.values()), tuple(sorted(reasons[s.name, i]))) for s, i, r in rows), key=repr)
        for at, name in new.items():
            reasons[at].append(name)


def frames(spark):
    specs = {s.name: s for s in (TOP, MIDDLE, LOW)}
    return {name: spark.createDataFrame(rows, specs[name].schema) for name, rows in TABLES.items()}


def test_fixpoint(spark):
    marked = quarantine(frames(spark), (TOP, MIDDLE, LOW))
    found = [
        (name, tuple(r)[:-1], tuple(sorted(r[REASONS]))) for name, df in marked.items()
        for r in df.select(*TABLES_COLUMNS[name], REASONS).collect()
    ]
    assert sorted(found, key=repr) == expected()
    assert values(kept_rows(marked["top"]), "a") == [("a1",), ("a4",), ("a5",)]
    # Nothing is left to set apart in the rest.
    rest = quarantine({name: kept_rows(df) for name, df in marked.items()}, (TOP, MIDDLE, LOW))
    assert all(df.filter(f"size({REASONS}) > 0").isEmpty() for df in rest.values())


TABLES_COLUMNS = {s.name: s.names for s in (TOP, MIDDLE, LOW)}


def test_untouched_tables_are_left_alone(spark):
    whole = frames(spark)
    assert set(quarantine(whole, (TOP, MIDDLE, LOW), suspects={"middle"})) == {"middle", "low"}
    assert set(quarantine(whole, (TOP, MIDDLE, LOW), suspects=set())) == set()


def test_keys_that_are_present(spark, rows):
    schema = "a string, note string"
    new, old = rows(schema, ("a1", "x"), ("a2", "y"), ("a3", "z")), rows(schema, ("a1", "o"), ("a8", "o"))
    marked = quarantine({"top": new, "middle": rows("b string, a string", ("b1", "a8"), ("b2", "a7"))},
                        (TOP, MIDDLE), present={"top": old})
    assert values(kept_rows(marked["top"]), "a") == [("a2",), ("a3",)]
    assert values(kept_rows(marked["middle"]), "b") == [("b1",)]


def test_a_key_that_most_rows_share_is_not_shuffled_to_one_task(spark):
    items = spark.range(4000).selectExpr("hex(id) AS c", "if(id % 3 = 0, 'lost', 'b1') AS b", "'a1' AS a")
    middle = spark.createDataFrame([("b1", "a1")], MIDDLE.schema)
    top = spark.createDataFrame([("a1", "x")], TOP.schema)
    marked = marked_rows(items, LOW, {"middle": middle, "top": top})
    assert marked.filter(f"size({REASONS}) > 0").count() == 1334
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" in plan.upper()


@pytest.fixture(scope="module")
def broken_feed():
    """A repeated seller, a wide state code, and the rows that refer to them."""
    feed = make_feed(5)
    feed["sellers"].append(dict(feed["sellers"][0]))
    feed["orders"][2]["order_status"] = "delivered twice"
    return feed


def test_the_rest_is_loaded_with_an_empty_report(spark, tmp_path, broken_feed):
    write_feed(broken_feed, tmp_path)
    layers = Layers.parquet(str(tmp_path))
    with pytest.raises(ConstraintViolation):
        refresh(spark, str(tmp_path), layers)
    report = refresh(spark, str(tmp_path), layers, on_violation="quarantine")
    lines = {r.constraint_name: r.violations for r in report.collect() if r.kind not in HARMLESS}
    assert set(lines.values()) == {0}
    out = {s.name: layers.clean.read(spark, rejected(s)) for s in CLEAN if layers.clean.find(spark, rejected(s)) is not None}
    seller = broken_feed["sellers"][0]["seller_id"]
    assert values(out["sellers"], "seller_id", REASONS) == [(seller, "sellers_key_unique")] * 2
    order = broken_feed["orders"][2]["order_id"]
    assert values(out["orders"], "order_id", REASONS) == [(order, "orders_order_status_width")]
    items = [i for i in broken_feed["order_items"] if i["seller_id"] == seller or i["order_id"] == order]
    assert out["order_items"].count() == len(items) > 0
    clean = {s.name: layers.clean.read(spark, s) for s in CLEAN}
    assert clean["sellers"].filter(f"seller_id = '{seller}'").isEmpty()
    assert clean["order_items"].count() == len(broken_feed["order_items"]) - len(items)
    counted = {r.table_name: r.violations for r in report.collect() if r.kind == "rejected"}
    assert counted["order_items"] == len(items) and counted["sellers"] == 2
    # A feed without faults empties the tables of rejected rows.
    write_feed(make_feed(5), tmp_path)
    refresh(spark, str(tmp_path), layers, on_violation="quarantine")
    assert layers.clean.read(spark, rejected(SELLERS)).isEmpty()
    assert layers.clean.read(spark, rejected(ORDERS)).isEmpty()


def test_append_keeps_old_rows_and_sets_repeated_keys_apart(spark, tmp_path):
    write_feed(make_feed(3), tmp_path)
    layers = Layers.parquet(str(tmp_path))
    refresh(spark, str(tmp_path), layers)
    before = {s.name: layers.clean.read(spark, s).count() for s in CLEAN}
    second = make_feed(3)
    for row in second["orders"][:10]:
        row["order_id"] = f"new-{row['order_id']}"
    write_feed(second, tmp_path)
    load_raw(spark, str(tmp_path), layers.raw)
    report = load_clean(spark, layers, on_violation="quarantine", mode="append")
    assert {r.violations for r in report.collect() if r.kind not in HARMLESS} == {0}
    assert layers.clean.read(spark, ORDERS).count() == before["orders"] + 10
    assert layers.clean.read(spark, rejected(ORDERS)).count() == 140
