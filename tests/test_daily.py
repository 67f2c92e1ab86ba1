"""Marts from daily sums against the same marts worked out row by row, after batches of all kinds."""

from __future__ import annotations

import datetime
from decimal import Decimal
from pathlib import Path

import pytest

from feira.plans.daily import HELD, UNDATED, DailySums, UnfinishedUpdate
from feira.plans.marts import all_marts
from feira.specs import CUSTOMERS, MARTS, ORDER_ITEMS, ORDER_REVIEWS, ORDERS, PRODUCTS, TRANSLATION

from test_refresh import expected_marts, make_feed

SPECS = {s.name: s for s in (CUSTOMERS, ORDER_ITEMS, ORDER_REVIEWS, ORDERS, PRODUCTS, TRANSLATION)}
LOOKUPS = ("customers", "products", "product_category_name_translation")


def frame(spark, name, rows):
    if name == "order_reviews":
        rows = [r for r in rows if r["review_answer_timestamp"]]
    return spark.createDataFrame([tuple(r.get(c) for c in SPECS[name].names) for r in rows], SPECS[name].schema)


def completed(feed):
    """With rows for all customers and categories that others refer to, as the clean tables have them."""
    known, kinds = ({r[c] for r in feed[t]} for t, c in (("customers", "customer_id"), (LOOKUPS[2], "product_category_name")))
    used = {o["customer_id"] for o in feed["orders"]} | {f"c{i}" for i in range(50)}
    used_kinds = {p["product_category_name"] for p in feed["products"]}
    return feed | {
        "customers": feed["customers"] + [{"customer_id": c} for c in sorted(used - known - {None})],
        LOOKUPS[2]: feed[LOOKUPS[2]] + [{"product_category_name": k} for k in sorted(used_kinds - kinds - {None})],
    }


def frames(spark, feed):
    return {name: frame(spark, name, rows) for name, rows in completed(feed).items() if name in SPECS}


def found(daily, spark, clean):
    marts = daily.marts(spark, {name: clean[name] for name in LOOKUPS})
    assert {name: df.schema.simpleString() for name, df in marts.items()} == {
        name: df.schema.simpleString() for name, df in all_marts(clean, keep=lambda df, label: df).items()
    }
    return {m.name: sorted((tuple(r) for r in marts[m.name].collect()), key=lambda r: repr(r[:2])) for m in MARTS}


def check(daily, spark, feed):
    got = found(daily, spark, frames(spark, feed))
    for name, expected in expected_marts(feed).items():
        assert got[name] == expected, name


def folders(daily, name):
    return {p.name for p in Path(daily.path(name)).glob("day=*")}


@pytest.mark.parametrize("unit", ["day", "month"])
def test_marts_after_batches(spark, tmp_path, unit):
    feed = make_feed(31)
    orders = {o["order_id"]: o for o in feed["orders"]}
    feed["order_items"] = [i for i in feed["order_items"] if i["order_id"] in orders]
    daily = DailySums(str(tmp_path), unit=unit)
    # First load: the older two thirds, without some items, and with orders that will change.
    ordered = sorted(orders.values(), key=lambda o: o["order_purchase_timestamp"])
    early = {o["order_id"] for o in ordered[:100]}
    late_items = [i for n, i in enumerate(feed["order_items"]) if i["order_id"] in early and n % 4 == 0]
    late_reviews = [r for n, r in enumerate(feed["order_reviews"]) if r["order_id"] in early and n % 3 == 0]
    first = dict(feed)
    shift = datetime.timedelta(days=3)
    first["orders"] = [
        dict(o, order_status="created", order_purchase_timestamp=o["order_purchase_timestamp"] - shift) if n % 9 == 0 else o
        for n, o in enumerate(ordered[:100])
    ]
    first["order_items"] = [i for i in feed["order_items"] if i["order_id"] in early and i not in late_items]
    first["order_reviews"] = [r for r in feed["order_reviews"] if r["order_id"] in early and r not in late_reviews]
    first["customers"] = [dict(c, customer_state="ZZ") if n % 8 == 0 else c for n, c in enumerate(feed["customers"])]
    daily.rebuild(spark, frames(spark, first))
    check(daily, spark, first)
    customers = frames(spark, first)["customers"]
    # Late items and reviews of orders that are there, one item with another price than before.
    wrong = dict(feed["order_items"][1], price=feed["order_items"][1]["price"] + 1)
    daily.update(spark, {"order_items": frame(spark, "order_items", [*late_items, wrong]),
                         "order_reviews": frame(spark, "order_reviews", late_reviews)}, customers)
    # The price set right, orders that move three days and are delivered, new orders with all that is theirs.
    rest = {o["order_id"] for o in ordered[100:]}
    batch = {
        "orders": [o for n, o in enumerate(ordered) if n >= 100 or n % 9 == 0],
        "order_items": [i for i in feed["order_items"] if i["order_id"] in rest] + [feed["order_items"][1]],
        "order_reviews": [r for r in feed["order_reviews"] if r["order_id"] in rest],
    }
    daily.update(spark, {name: frame(spark, name, rows) for name, rows in batch.items()}, customers)
    check(daily, spark, dict(feed, customers=first["customers"]))
    # Customers that move to another state.
    moved = [c for n, c in enumerate(feed["customers"]) if n % 8 == 0]
    daily.update(spark, {"customers": frame(spark, "customers", moved)}, frames(spark, feed)["customers"])
    check(daily, spark, feed)


@pytest.fixture
def small(spark, tmp_path):
    """Orders of six days, one a day, and one without a time."""
    feed = {name: [] for name in SPECS}
    feed["customers"] = [{"customer_id": "c", "customer_state": "SP"}]
    feed["products"] = [{"product_id": "p", "product_category_name": "k"}]
    feed["product_category_name_translation"] = [{"product_category_name": "k", "product_category_name_english": "kind"}]
    for i in range(7):
        bought = datetime.datetime(2018, 3, 1 + i, 12) if i < 6 else None
        feed["orders"].append({"order_id": f"o{i}", "customer_id": "c", "order_status": "delivered", "order_purchase_timestamp": bought})
        feed["order_items"].append({"order_id": f"o{i}", "order_item_id": 1, "product_id": "p", "price": Decimal(10 + i)})
        feed["order_reviews"].append({"review_id": "r", "order_id": f"o{i}", "review_score": 3, "review_answer_timestamp": bought or datetime.datetime(2018, 1, 1)})
    daily = DailySums(str(tmp_path))
    daily.rebuild(spark, frames(spark, feed))
    return daily, feed


def total(daily, spark, feed):
    return float(found(daily, spark, frames(spark, feed))["total_sales_of_delivered_order"][0][0])


def test_days_that_are_not_touched_are_not_read(spark, small):
    """Their items, reviews and sums may be unreadable; of their orders the keys are looked up."""
    daily, feed = small
    kept = {}
    for name in ("order_items", "order_reviews", "day_cards", "day_states", "day_products"):
        for file in Path(daily.path(name)).glob("day=*/*.parquet"):
            if "2018-03-05" not in file.parent.name:
                kept[file] = file.read_bytes()
                file.write_bytes(b"not a table")
                file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    item = {"order_id": "o4", "order_item_id": 2, "product_id": "p", "price": Decimal(100)}
    days = daily.update(spark, {"order_items": frame(spark, "order_items", [item])}, frame(spark, "customers", feed["customers"]))
    assert days == [datetime.date(2018, 3, 5)] and len(kept) == 30
    for file, content in kept.items():
        assert file.read_bytes() == b"not a table"
        file.write_bytes(content)
    assert total(daily, spark, feed) == sum(range(10, 16)) + 100


def test_a_day_that_loses_its_orders_loses_its_folders(spark, small):
    daily, feed = small
    dated = dict(feed["orders"][6], order_purchase_timestamp=datetime.datetime(2018, 3, 2, 3))
    moved = dict(feed["orders"][0], order_purchase_timestamp=datetime.datetime(2018, 3, 9, 3))
    days = daily.update(spark, {"orders": frame(spark, "orders", [dated, moved])}, frame(spark, "customers", feed["customers"]))
    assert days == [UNDATED, *[datetime.date(2018, 3, d) for d in (1, 2, 9)]]
    for name in (*HELD, "day_cards", "day_states", "day_products"):
        assert folders(daily, name) == {f"day=2018-03-0{d}" for d in (2, 3, 4, 5, 6, 9)}, name
    assert total(daily, spark, feed) == sum(range(10, 17))


def test_an_update_that_was_cut_off(spark, small, monkeypatch):
    daily, feed = small
    item = {"order_id": "o4", "order_item_id": 2, "product_id": "p", "price": Decimal(100)}
    batch, customers = {"order_items": frame(spark, "order_items", [item])}, frame(spark, "customers", feed["customers"])
    monkeypatch.setattr(DailySums, "_end", lambda self, spark: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        daily.update(spark, batch, customers)
    monkeypatch.undo()
    for again in (lambda: daily.update(spark, batch, customers), lambda: daily.marts(spark, frames(spark, feed))):
        with pytest.raises(UnfinishedUpdate):
            again()
    feed["order_items"].append(item)
    daily.rebuild(spark, frames(spark, feed))
    assert total(daily, spark, feed) == sum(range(10, 16)) + 100


def test_no_orders(spark, tmp_path):
    daily, clean = DailySums(str(tmp_path)), frames(spark, {name: [] for name in SPECS})
    daily.rebuild(spark, clean)
    got = found(daily, spark, clean)
    expected = all_marts(clean, keep=lambda df, label: df)
    assert got == {m.name: sorted((tuple(r) for r in expected[m.name].collect()), key=lambda r: repr(r[:2])) for m in MARTS}


def test_tables_without_a_change_stay_as_they_are(spark, tmp_path):
    feed = make_feed(31)
    known = {o["order_id"] for o in feed["orders"]}
    feed["order_items"] = [i for i in feed["order_items"] if i["order_id"] in known]
    reviews = [r for r in feed["order_reviews"] if r["order_id"] in known]
    daily = DailySums(str(tmp_path), unit="month")
    daily.rebuild(spark, frames(spark, feed | {"order_reviews": reviews[::2]}))
    before = {name: {str(p) for p in Path(daily.path(name)).rglob("*.parquet")} for name in HELD}
    clean = frames(spark, feed)
    daily.update(spark, {"order_reviews": frame(spark, "order_reviews", reviews[1::2])}, clean["customers"])
    after = {name: {str(p) for p in Path(daily.path(name)).rglob("*.parquet")} for name in HELD}
    assert [name for name in HELD if before[name] != after[name]] == ["order_reviews"]
    check(daily, spark, feed | {"order_reviews": reviews})


def test_late_items_of_an_order_that_is_there_twice(spark, tmp_path):
    """Rows go to each day of their order, also those that were there."""
    feed = make_feed(31)
    order = next(o for o in feed["orders"] if o["order_purchase_timestamp"])
    again = dict(order, order_purchase_timestamp=order["order_purchase_timestamp"] + datetime.timedelta(days=70))
    item = next(i for i in feed["order_items"])
    rows = [dict(item, order_id=order["order_id"], order_item_id=100 + n) for n in range(3)]
    daily = DailySums(str(tmp_path), unit="month")
    daily.rebuild(spark, frames(spark, feed | {"orders": [order, again], "order_items": rows[:1], "order_reviews": []}))
    daily.update(spark, {"order_items": frame(spark, "order_items", rows[1:])}, frames(spark, feed)["customers"])
    held = daily.read(spark, "order_items").groupBy("day", "order_item_id").count().collect()
    assert len({r.day for r in held}) == 2
    assert sorted((r.order_item_id, r["count"]) for r in held) == [(100, 2), (100, 2), (101, 1), (101, 1), (102, 1), (102, 1)]
