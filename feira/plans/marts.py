"""The eight result tables over the clean tables.

Every mart reports on the trailing window of `recent`. Four of them count orders and share one
aggregate row (`scorecard`); the other four work on items, three of these on the sales per order
(`order_sales`). Each can be run alone: Spark prunes what it does not use. Run together, they share the
items sold in the window (`sold_items`), so the largest table is shuffled once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feira.functions.ages import age_sums, days_and_hours, mean_age
from feira.functions.states import state_name
from feira.functions.text import fit
from feira.operators.recent import PURCHASED, recent, window_start
from feira.sources.scratch import keep
from feira.specs import MONEY_MEAN, MONEY_SUM, PAIRED_COUNT, PAIRED_SUM

# The status of a finished order, the row labels of the lateness table, the width of
# the shipping time text, the length of the category table.
DELIVERED = "delivered"
LATE, ON_TIME = "late", "on-time"
SHIPPING_TIME_WIDTH = 16
TOP_CATEGORIES = 10


def scorecard(
    orders: DataFrame, start: Column | None = None, delivered: str = DELIVERED
) -> DataFrame:
    """Counts and age sums of all orders in the window, one row from one scan."""
    return recent(orders, start).agg(*card_sums(delivered))


def card_sums(delivered: str) -> list[Column]:
    """Aggregates of orders that the scorecard holds; all of them can be added up over parts of the orders."""
    arrived, promised = F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date")
    return [
        F.count("order_id").alias("orders"),
        F.count("*").alias("rows"),
        F.count_if(F.col("order_status") == delivered).alias("delivered"),
        F.count_if(arrived > promised).alias("late"),
        F.count_if(arrived <= promised).alias("on_time"),
        *age_sums(arrived, F.col(PURCHASED)),
    ]


def total_order(card: DataFrame) -> DataFrame:
    """Orders in the window, whatever their status."""
    return card.select(F.col("orders").alias("count"))


def successful_delivery_percentage(card: DataFrame) -> DataFrame:
    """Share of delivered orders; no row when none was delivered."""
    share = F.col("delivered").cast("double") * 100.0 / F.col("rows")
    return card.filter(F.col("delivered") > 0).select(share.alias("delivered_order_percentage"))


def average_shipping_duration(card: DataFrame) -> DataFrame:
    """Mean calendar age at delivery as days and hours; months are left out, NULL without any."""
    name = "average_shipping_time"
    text = card.select(days_and_hours(mean_age()).alias(name))
    return text.select(fit(F.col(name), SHIPPING_TIME_WIDTH).alias(name))


def order_delivery_lateness(card: DataFrame) -> DataFrame:
    """Always two rows; orders not yet delivered are in neither."""
    rows = [
        F.struct(F.lit(label).alias("order_delivery"), F.col(count).alias("count"))
        for label, count in ((LATE, "late"), (ON_TIME, "on_time"))
    ]
    return card.select(F.inline(F.array(*rows)))


def delivered_orders(
    orders: DataFrame, start: Column | None = None, delivered: str = DELIVERED
) -> DataFrame:
    return recent(orders, start).filter(F.col("order_status") == delivered)


def own_stage(df: DataFrame, label: str) -> DataFrame:
    """Ends the stage that computes `df`, in place of storing it under `label`.

    AQE splits a hot key only where both join inputs come straight from a shuffle. Ending the stage
    before such a join sees to that, and shows the real size of the input, so that a small one is
    broadcast.
    """
    return df.hint("rebalance")


def sold_items(
    orders: DataFrame, items: DataFrame, start: Column | None = None, delivered: str = DELIVERED
) -> DataFrame:
    """(order_id, product_id, price) of the items of delivered orders in the window.

    Worth storing where several marts follow: each of them takes these in place of all items.
    """
    sold = delivered_orders(orders, start, delivered).select("order_id")
    return items.select("order_id", "product_id", "price").join(sold, "order_id")


def order_sales(
    orders: DataFrame, items: DataFrame, start: Column | None = None, delivered: str = DELIVERED
) -> DataFrame:
    """(order_id, customer_id, sales) of delivered orders with items; freight is not included.

    Joined before summing: the items of the window are a small part of all, and the sum combines them
    in the task that joins them. AQE splits the items of a very large order in the join; with the
    session settings it does so at the price of one more shuffle of partial sums.
    """
    sold = delivered_orders(orders, start, delivered).select("order_id", "customer_id")
    paid = items.select("order_id", "price").join(sold, "order_id")
    return paid.groupBy("order_id", "customer_id").agg(F.sum("price").cast(MONEY_SUM).alias("sales"))


def total_sales_of_delivered_order(sales: DataFrame) -> DataFrame:
    """Sum of all item prices; NULL without any."""
    return sales.agg(F.sum("sales").cast(MONEY_SUM).alias("total_sales"))


def average_sales_of_delivered_order(sales: DataFrame) -> DataFrame:
    """Mean over orders of their item prices; orders without items do not count."""
    return sales.agg(F.avg("sales").cast(MONEY_MEAN).alias("average_sales"))


def total_sales_of_delivered_order_per_state(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales by the customer's state, largest first, then by code; those without a state form one group.

    Summed per customer before the join, so a customer with very many orders is one row in it.
    """
    per_customer = sales.groupBy("customer_id").agg(F.sum("sales").alias("sales"))
    per_state = (
        per_customer.join(customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy("customer_state")
        .agg(F.sum("sales").cast(MONEY_SUM).alias("total_sales"))
    )
    return named_states(per_state)


def named_states(per_state: DataFrame) -> DataFrame:
    named = per_state.withColumn("customer_state_name", state_name(F.col("customer_state")))
    return named.orderBy(F.col("total_sales").desc_nulls_first(), "customer_state")


def review_factors() -> list[Column]:
    """Aggregates of the reviews of an order."""
    return [
        F.count("*").alias("reviews"),
        F.sum(F.col("review_score").cast("bigint")).alias("score_sum"),
        F.count("review_score").alias("scores"),
    ]


def review_scores(
    orders: DataFrame,
    reviews: DataFrame,
    start: Column | None = None,
    delivered: str = DELIVERED,
    keep=own_stage,
) -> DataFrame:
    """Number of reviews, score sum and number of scores per delivered order with reviews."""
    per_order = reviews.groupBy("order_id").agg(*review_factors())
    sold = delivered_orders(orders, start, delivered).select("order_id")
    return keep(sold.join(per_order, "order_id"), "review-scores")


def category_sales(
    items: DataFrame, scores: DataFrame, products: DataFrame, translation: DataFrame
) -> DataFrame:
    """Sales and mean review score by English category name, for the orders that have `scores`.

    Each item counts once per review of its order: its price is added that many times, and an order
    without reviews is left out. Items and reviews are not paired for it: multiplying by the number
    of reviews gives the same sums. Categories without an English name form one group.
    """
    reviewed = items.select("order_id", "product_id", "price").join(scores, "order_id")
    return by_category(reviewed.groupBy("product_id").agg(*product_sums()), products, translation)


def product_sums() -> list[Column]:
    """Aggregates of items with the review factors of their order."""
    return [
        F.sum(F.col("price") * F.col("reviews")).alias("sales"),
        F.sum(F.col("score_sum").cast(PAIRED_COUNT)).alias("score_sum"),
        F.sum(F.col("scores").cast(PAIRED_COUNT)).alias("scores"),
    ]


def by_category(per_product: DataFrame, products: DataFrame, translation: DataFrame) -> DataFrame:
    """Sums per product as sums per English category name."""
    per_category = (
        per_product.join(products.select("product_id", "product_category_name"), "product_id")
        .groupBy("product_category_name")
        .agg(*[F.sum(c).alias(c) for c in ("sales", "score_sum", "scores")])
    )
    rating = F.sum("score_sum").cast("double") / F.nullif(F.sum("scores").cast("double"), F.lit(0.0))
    return (
        per_category.join(translation, "product_category_name")
        .groupBy(F.col("product_category_name_english").alias("product_category"))
        .agg(F.sum("sales").cast(PAIRED_SUM).alias("total_sales"), rating.alias("average_rating"))
    )


def ranked_categories(categories: DataFrame, top: int = TOP_CATEGORIES) -> DataFrame:
    """The `top` categories by sales with their `rank`; of equal sales the lower name comes first.

    The window holds one row per category, and Spark cuts it to `top` rows beforehand.
    """
    best_first = Window.orderBy(
        F.col("total_sales").desc_nulls_first(), F.col("product_category").asc_nulls_last()
    )
    ranked = categories.withColumn("rank", F.row_number().over(best_first))
    return ranked.filter(F.col("rank") <= top)


def top_product_category_by_sales(categories: DataFrame, top: int = TOP_CATEGORIES) -> DataFrame:
    return ranked_categories(categories, top).drop("rank")


def all_marts(
    clean: Mapping[str, DataFrame], delivered: str = DELIVERED, keep=keep
) -> dict[str, DataFrame]:
    """Every mart by table name; `keep(df, label)` stores what several of them share."""
    orders, items = clean["orders"], clean["order_items"]
    start = keep(window_start(orders), "window-start").scalar()
    card = keep(scorecard(orders, start, delivered), "scorecard")
    sold = keep(sold_items(orders, items, start, delivered), "sold-items")
    sales = keep(order_sales(orders, sold, start, delivered), "order-sales")
    scores = review_scores(orders, clean["order_reviews"], start, delivered, keep)
    categories = category_sales(
        sold, scores, clean["products"], clean["product_category_name_translation"]
    )
    return {
        "total_order": total_order(card),
        "successful_delivery_percentage": successful_delivery_percentage(card),
        "total_sales_of_delivered_order": total_sales_of_delivered_order(sales),
        "average_sales_of_delivered_order": average_sales_of_delivered_order(sales),
        "total_sales_of_delivered_order_per_state": total_sales_of_delivered_order_per_state(
            sales, clean["customers"]
        ),
        "average_shipping_duration": average_shipping_duration(card),
        "order_delivery_lateness": order_delivery_lateness(card),
        "top_product_category_by_sales": top_product_category_by_sales(categories),
    }
