from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from feira.functions.states import STATE_NAMES
from feira.operators.recent import recent, window_start
from feira.plans import marts

from conftest import values

ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
    "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz"
)
ITEMS = "order_id string, product_id string, price decimal(10,2)"
REVIEWS = "order_id string, review_score tinyint"
NEWEST = datetime(2018, 8, 31, 12)


def order(number, status="delivered", bought=NEWEST, arrived=None, promised=None, customer="c"):
    return (number, customer, status, bought, arrived, promised)


def money(text):
    return None if text is None else Decimal(text)


@pytest.fixture
def item(rows):
    return lambda *lines: rows(ITEMS, *[(o, p, money(x)) for o, p, x in lines])


def test_window_is_clamped_to_the_month_end_and_inclusive(rows):
    df = rows(
        ORDERS,
        order("newest"),
        order("on the bound", bought=datetime(2018, 2, 28, 12)),
        order("before", bought=datetime(2018, 2, 28, 11, 59, 59)),
        order("stub", None, None),
    )
    assert values(window_start(df)) == [(datetime(2018, 2, 28, 12),)]
    assert values(recent(df), "order_id") == [("newest",), ("on the bound",)]


def test_counts_take_every_status(rows):
    df = rows(ORDERS, order("a"), order("b", "shipped"), order("c", None), order("d", None, None))
    card = marts.scorecard(df)
    assert values(marts.total_order(card)) == [(3,)]
    assert values(marts.successful_delivery_percentage(card)) == [(100.0 / 3,)]


def test_no_delivered_order_gives_no_share(rows):
    card = marts.scorecard(rows(ORDERS, order("a", "shipped")))
    assert values(marts.successful_delivery_percentage(card)) == []


def test_no_orders_at_all(rows):
    card = marts.scorecard(rows(ORDERS))
    assert values(marts.total_order(card)) == [(0,)]
    assert values(marts.successful_delivery_percentage(card)) == []
    assert values(marts.average_shipping_duration(card)) == [(None,)]
    assert values(marts.order_delivery_lateness(card)) == [("late", 0), ("on-time", 0)]


def test_lateness(rows):
    due = datetime(2018, 9, 10)
    df = rows(
        ORDERS,
        order("late", arrived=datetime(2018, 9, 10, 0, 0, 1), promised=due),
        order("sharp", "shipped", arrived=due, promised=due),
        order("early", arrived=datetime(2018, 9, 1), promised=due),
        order("open", promised=due),
        order("old", bought=datetime(2017, 1, 1), arrived=datetime(2018, 9, 11), promised=due),
    )
    assert values(marts.order_delivery_lateness(marts.scorecard(df))) == [("late", 1), ("on-time", 2)]


def test_shipping_time_takes_every_status_with_a_date(rows):
    df = rows(
        ORDERS,
        order("a", arrived=datetime(2018, 9, 12, 22)),
        order("b", "canceled", arrived=datetime(2018, 9, 12, 22)),
        order("c"),
    )
    assert values(marts.average_shipping_duration(marts.scorecard(df))) == [("12 days 10 hours",)]


def test_sales(rows, item):
    df = rows(
        ORDERS,
        order("a"),
        order("b"),
        order("without items"),
        order("without prices"),
        order("x", "shipped"),
        order("old", bought=datetime(2017, 1, 1)),
    )
    items = item(
        ("a", "p", "10.10"), ("a", "q", "0.20"), ("b", "p", "5.00"), ("b", "q", None),
        ("without prices", "p", None), ("x", "p", "99.00"), ("old", "p", "99.00"), (None, "p", "1.00"),
    )
    sales = marts.order_sales(df, items)
    assert values(marts.total_sales_of_delivered_order(sales)) == [(Decimal("15.30"),)]
    assert values(marts.average_sales_of_delivered_order(sales)) == [(Decimal("7.650000"),)]
    assert values(marts.order_sales(df, marts.sold_items(df, items))) == values(sales)
    none = marts.order_sales(df, items, delivered="lost")
    assert values(marts.total_sales_of_delivered_order(none)) == [(None,)]
    assert values(marts.average_sales_of_delivered_order(none)) == [(None,)]


def test_states(rows, item):
    df = rows(
        ORDERS,
        order("a", customer="sp"), order("b", customer="sp"), order("c", customer="stub"),
        order("d", customer="odd"), order("e", customer=None), order("f", customer="ac"),
    )
    items = item(
        ("a", "p", "1.00"), ("b", "p", "2.00"), ("c", "p", "7.00"), ("d", "p", "5.00"), ("e", "p", "50.00"),
        ("f", "p", None),
    )
    customers = rows(
        "customer_id string, customer_state string",
        ("sp", "SP"), ("stub", None), ("odd", "ZZ"), ("unused", "RJ"), ("ac", "AC"),
    )
    sales = marts.order_sales(df, items)
    found = marts.total_sales_of_delivered_order_per_state(sales, customers)
    assert [tuple(r) for r in found.collect()] == [
        ("AC", None, "ACRE"),
        (None, Decimal("7.00"), None),
        ("ZZ", Decimal("5.00"), "ZZ"),
        ("SP", Decimal("3.00"), "SAO PAULO"),
    ]
    assert len(STATE_NAMES) == 27


CATALOGUE = "product_id string, product_category_name string"
NAMES = "product_category_name string, product_category_name_english string"


def categories(orders, items, reviews, products, names):
    scores = marts.review_scores(orders, reviews)
    alone = marts.category_sales(items, scores, products, names)
    shared = marts.category_sales(marts.sold_items(orders, items), scores, products, names)
    assert values(alone) == values(shared)
    return alone


def test_each_item_counts_once_per_review(rows, item):
    df = rows(ORDERS, order("two"), order("one"), order("none"))
    items = item(("two", "p", "10.00"), ("two", "q", "1.00"), ("one", "p", "4.00"), ("none", "p", "99.00"))
    reviews = rows(REVIEWS, ("two", 5), ("two", None), ("one", 2))
    products = rows(CATALOGUE, ("p", "x"), ("q", "y"))
    names = rows(NAMES, ("x", "X"), ("y", None))
    found = categories(df, items, reviews, products, names)
    assert values(found) == [("X", Decimal("24.00"), 3.5), (None, Decimal("2.00"), 5.0)]


def test_one_order_with_very_many_items_and_reviews_does_not_overflow(rows):
    items = rows(ITEMS, ("a", "p", Decimal("99999999.99")), ("a", "q", Decimal("0.01")))
    scores = rows(
        "order_id string, reviews bigint, score_sum bigint, scores bigint", ("a", 4 * 10**18, 8 * 10**18, 4 * 10**18)
    )
    products = rows(CATALOGUE, ("p", "x"), ("q", "x"))
    found = marts.category_sales(items, scores, products, rows(NAMES, ("x", "X")))
    assert values(found) == [("X", Decimal(4 * 10**26), 2.0)]


def test_untranslated_categories_are_one_group(rows, item):
    df = rows(ORDERS, order("a"))
    items = item(("a", "p", "1.00"), ("a", "q", "2.00"), ("a", "r", "4.00"), ("a", "loose", "8.00"))
    products = rows(CATALOGUE, ("p", "x"), ("q", "y"), ("r", "z"), ("loose", None))
    names = rows(NAMES, ("x", None), ("y", None), ("z", "Z"))
    found = categories(df, items, rows(REVIEWS, ("a", None)), products, names)
    assert values(found) == [("Z", Decimal("4.00"), None), (None, Decimal("3.00"), None)]


def test_ties_at_the_last_rank_go_to_the_lower_name(rows):
    lines = [(f"c{i:02}", Decimal(100 - i), 3.0) for i in range(9)] + [
        ("b", Decimal(1), 1.0), ("a", Decimal(1), 1.0), (None, Decimal(1), 1.0),
    ]
    df = rows("product_category string, total_sales decimal(20,2), average_rating double", *lines)
    top = marts.ranked_categories(df).orderBy("rank").collect()
    assert [r.product_category for r in top] == [f"c{i:02}" for i in range(9)] + ["a"]
    assert [r["rank"] for r in top] == list(range(1, 11))
    assert len(values(marts.top_product_category_by_sales(df))) == 10
