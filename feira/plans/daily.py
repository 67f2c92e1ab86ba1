"""The marts from sums per day of purchase, kept up to date by the days that new and changed rows touch.

Orders, items and reviews are held once more, with the columns that the marts need, in one folder per day
on which their order was bought. Every day has its sums: of orders, of sales per state, of sales and scores per
product. A batch of new, late or changed rows reads and writes the days of its orders only. The
marts add up the sums of the days of the window; the day in which the window begins is summed anew,
from its hour on.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Mapping
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feira.operators.recent import PURCHASED
from feira.plans import marts
from feira.sources.files import delete, exists, read_text, write_text
from feira.sources.parallel import run_all
from feira.sources.scratch import keep, keep_all, scratch_of_run
from feira.specs import MONEY_MEAN, MONEY_SUM, PAIRED_COUNT

# What is held of each clean table, and the key of its rows.
HELD = {
    "orders": (
        "order_id",
        "customer_id",
        "order_status",
        PURCHASED,
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
    ),
    "order_items": ("order_id", "order_item_id", "product_id", "price"),
    "order_reviews": ("order_id", "review_id", "review_score"),
}
KEYS = {
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_reviews": ["order_id", "review_id"],
}
CARDS, STATES, PRODUCTS = "day_cards", "day_states", "day_products"
DAY = "day"
# Orders without a time of purchase lie in the folder of this day, which no window reaches.
UNDATED = datetime.date(1900, 1, 1)
_PENDING = "_pending"


class UnfinishedUpdate(RuntimeError):
    """An update was cut off, so the days do not fit together; `rebuild` sets them right."""


def _added(columns: Mapping[str, str]) -> list[Column]:
    return [F.sum(name).cast(kind).alias(name) for name, kind in columns.items()]


@dataclass(frozen=True)
class DailySums:
    """The tables under `root`; `delivered` is the status whose sales count.

    With ``unit="month"``, a folder holds a month under its first day, for shops with few orders a day.
    """

    root: str
    delivered: str = marts.DELIVERED
    unit: str = "day"

    def day_of(self, purchased: Column) -> Column:
        return F.coalesce(F.date_trunc(self.unit, purchased).cast("date"), F.lit(UNDATED))

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def read(self, spark: SparkSession, name: str, days: list[datetime.date] | None = None) -> DataFrame:
        """A table, or the folders of some of its days."""
        schema = StructType.fromJson(json.loads(read_text(spark, f"{self.path(name)}.schema")))
        df = spark.read.schema(schema).parquet(self.path(name))
        return df if days is None else df.filter(F.col(DAY).isin(days))

    # --- sums

    def _sums(self, held: Mapping[str, DataFrame], customers: DataFrame, keep=lambda df, _: df) -> dict[str, DataFrame]:
        """The three tables of sums over the days of `held`; `keep` may store the sales per order, which two of them add up."""
        sold = held["orders"].filter(F.col("order_status") == self.delivered).select(DAY, "order_id", "customer_id")
        # Both sides hold a day, which keeps the join to the folders that are read.
        paid = held["order_items"].groupBy(DAY, "order_id").agg(F.sum("price").cast(MONEY_SUM).alias("sales"))
        sales = keep(sold.join(paid, [DAY, "order_id"]).select(DAY, "customer_id", "sales"), "daily-sales")
        per_day = sales.groupBy(DAY).agg(F.sum("sales").cast(MONEY_SUM).alias("sales"), F.count("*").alias("sold_orders"))
        cards = held["orders"].groupBy(DAY).agg(F.max(PURCHASED).alias("newest"), *marts.card_sums(self.delivered))
        per_customer = sales.groupBy(DAY, "customer_id").agg(F.sum("sales").alias("sales"))
        states = (
            per_customer.join(customers.select("customer_id", "customer_state"), "customer_id")
            .groupBy(DAY, "customer_state")
            .agg(F.sum("sales").cast(MONEY_SUM).alias("sales"))
        )
        factors = held["order_reviews"].groupBy(DAY, "order_id").agg(*marts.review_factors())
        reviewed = sold.select(DAY, "order_id").join(factors, [DAY, "order_id"]).hint("rebalance")
        products = held["order_items"].join(reviewed, [DAY, "order_id"]).groupBy(DAY, "product_id").agg(*marts.product_sums())
        return {CARDS: cards.join(per_day, DAY, "left"), STATES: states, PRODUCTS: products}

    # --- keeping up to date

    def _write(self, df: DataFrame, name: str, days: list[datetime.date] | None) -> None:
        """Put the folders of `days`, or all, in the place of the old ones; days without rows lose theirs."""
        spark = df.sparkSession
        # A task per day, and several for a day with much.
        writer = df.hint("rebalance", DAY).write.partitionBy(DAY)
        if days is None:
            delete(spark, self.path(name))
            write_text(spark, f"{self.path(name)}.schema", df.schema.json())
            writer.parquet(self.path(name))
            return
        written = {r[0] for r in df.select(DAY).distinct().collect()}
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(self.path(name))
        for day in days:
            if day not in written:
                delete(spark, f"{self.path(name)}/{DAY}={day.isoformat()}")

    def _begin(self, spark: SparkSession) -> None:
        write_text(spark, self.path(_PENDING), "an update is running or was cut off")

    def _end(self, spark: SparkSession) -> None:
        delete(spark, self.path(_PENDING))

    def rebuild(self, spark: SparkSession, clean: Mapping[str, DataFrame]) -> None:
        """All days from the clean tables."""
        with scratch_of_run(spark):
            # Stored, as the days of items and reviews are looked up in them.
            orders = clean["orders"].select(*HELD["orders"], self.day_of(F.col(PURCHASED)).alias(DAY))
            held = {"orders": keep(orders, "daily-orders")}
            days = held["orders"].select("order_id", DAY)
            for name in ("order_items", "order_reviews"):
                held[name] = clean[name].select(*HELD[name]).join(days, "order_id")
            self._begin(spark)
            run_all(partial(self._write, df, name, None) for name, df in held.items())
            sums = self._sums({name: self.read(spark, name) for name in HELD}, clean["customers"], keep)
            run_all(partial(self._write, df, name, None) for name, df in sums.items())
            self._end(spark)

    def touched_days(self, spark: SparkSession, batch: Mapping[str, DataFrame]) -> list[datetime.date]:
        """Days of the orders in the batch, before and after it, and of the orders its other rows belong to.

        Of the days held, only the keys of orders and customers are read for it.
        """
        known = self.read(spark, "orders").select(DAY, "order_id", "customer_id")
        keys = {"order_id": [batch[name] for name in HELD if name in batch]}
        keys["customer_id"] = [batch["customers"]] if "customers" in batch else []
        used = {key: [df.select(key).distinct() for df in frames] for key, frames in keys.items() if frames}
        found = [known.join(reduce(DataFrame.union, dfs), key, "left_semi").select(DAY) for key, dfs in used.items()]
        if "orders" in batch:
            found.append(batch["orders"].select(self.day_of(F.col(PURCHASED)).alias(DAY)))
        if not found:
            return []
        # One value per day.
        return sorted(r[0] for r in reduce(DataFrame.union, found).distinct().collect())

    def update(self, spark: SparkSession, batch: Mapping[str, DataFrame], customers: DataFrame) -> list[datetime.date]:
        """Bring in new and changed rows of orders, items, reviews and customers; returns the days touched.

        A row takes the place of those with its key; an order whose time of purchase changes takes its
        items and reviews along to another day. Items and reviews whose order is not known wait for nothing: the
        clean tables have a row, without a time, for each order that is referred to, so bring it in as well.
        `customers` is the whole table as it is after the batch.
        """
        if exists(spark, self.path(_PENDING)):
            raise UnfinishedUpdate(read_text(spark, self.path(_PENDING)))
        with scratch_of_run(spark):
            # Stored, as the days, the rows replaced and the new rows all come from them.
            kinds = {name: self.read(spark, name).schema for name in HELD}
            typed = {
                name: batch[name].select(*[F.col(c).cast(kinds[name][c].dataType).alias(c) for c in HELD[name]])
                for name in HELD
                if name in batch
            }
            new = keep_all(typed)
            days = self.touched_days(spark, {**batch, **new})
            if not days:
                return days
            held = {}
            for name in HELD:
                held[name] = self.read(spark, name, days)
                if name in new:
                    held[name] = held[name].join(new[name].select(*KEYS[name]).distinct(), KEYS[name], "left_anti")
            rows, orders = {}, held["orders"]
            if "orders" in new:
                orders = orders.drop(DAY).unionByName(new["orders"]).withColumn(DAY, self.day_of(F.col(PURCHASED)))
                orders = rows["orders"] = keep(orders, "daily-orders")
            place = orders.select("order_id", DAY)
            # Rows move with their order, to each day of an order that is there several times; else they stay where they are.
            moving = "orders" in new or not place.groupBy("order_id").count().filter("count > 1").isEmpty()
            for name in ("order_items", "order_reviews"):
                columns = (*HELD[name], DAY)
                if moving:
                    old = held[name].drop(DAY)
                    every = (old.unionByName(new[name]) if name in new else old).join(place, "order_id")
                elif name in new:
                    every = held[name].select(*columns).unionByName(new[name].join(place, "order_id").select(*columns))
                else:
                    continue
                rows[name] = keep(every.select(*columns), f"daily-{name}")
            # Tables without a change are read where they are.
            sums = {name: keep(df, name) for name, df in self._sums({**held, **rows}, customers, keep).items()}
            self._begin(spark)
            run_all(partial(self._write, df, name, days) for name, df in {**rows, **sums}.items())
            self._end(spark)
        return days

    # --- marts

    def window(self, spark: SparkSession) -> tuple[datetime.datetime, datetime.date] | None:
        """Begin of the window and its day; None without any dated order."""
        cards = self.read(spark, CARDS)
        start = (F.max("newest") - F.expr("INTERVAL '6' MONTH")).alias("start")
        begin = cards.agg(start).select("start", self.day_of(F.col("start")).alias("day")).first()
        return None if begin["start"] is None else (begin["start"], begin["day"])

    def marts(self, spark: SparkSession, clean: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """Every mart by table name. Of `clean`, customers, products and category names are read."""
        if exists(spark, self.path(_PENDING)):
            raise UnfinishedUpdate(read_text(spark, self.path(_PENDING)))
        begin = self.window(spark)
        parts = {name: self.read(spark, name) for name in (CARDS, STATES, PRODUCTS)}
        if begin is None:
            parts = {name: df.limit(0) for name, df in parts.items()}
        else:
            start, day = begin
            held = {name: self.read(spark, name, [day]) for name in HELD}
            held["orders"] = held["orders"].filter(F.col(PURCHASED) >= F.lit(str(start)).cast("timestamp_ntz"))
            edge = self._sums(held, clean["customers"])
            parts = {
                name: df.filter(F.col(DAY) > F.lit(day)).unionByName(edge[name].select(*df.columns))
                for name, df in parts.items()
            }
        counts = dict.fromkeys(("orders", "rows", "delivered", "late", "on_time", "ages", "sold_orders"), "long")
        amounts = {"age_months": "long", "age_days": "long", "age_micros": "decimal(28,0)", "sales": MONEY_SUM}
        card = parts[CARDS].agg(
            *[F.coalesce(F.sum(c), F.lit(0)).cast(kind).alias(c) for c, kind in counts.items()], *_added(amounts)
        )
        states = parts[STATES].groupBy("customer_state").agg(F.sum("sales").cast(MONEY_SUM).alias("total_sales"))
        paired = {"score_sum": PAIRED_COUNT, "scores": PAIRED_COUNT}
        products = parts[PRODUCTS].groupBy("product_id").agg(F.sum("sales").alias("sales"), *_added(paired))
        categories = marts.by_category(products, clean["products"], clean["product_category_name_translation"])
        mean = F.col("sales") / F.nullif(F.col("sold_orders"), F.lit(0)).cast("decimal(20,0)")
        return {
            "total_order": marts.total_order(card),
            "successful_delivery_percentage": marts.successful_delivery_percentage(card),
            "total_sales_of_delivered_order": card.select(F.col("sales").alias("total_sales")),
            "average_sales_of_delivered_order": card.select(mean.cast(MONEY_MEAN).alias("average_sales")),
            "total_sales_of_delivered_order_per_state": marts.named_states(states),
            "average_shipping_duration": marts.average_shipping_duration(card),
            "order_delivery_lateness": marts.order_delivery_lateness(card),
            "top_product_category_by_sales": marts.top_product_category_by_sales(categories),
        }
