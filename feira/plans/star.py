"""The order and catalogue tables of a TPC-H-like star schema under this package's column names.

Used to run the jobs on such tables. Nothing here is computed unless a job uses the column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.functions.states import STATE_NAMES
from feira.specs import MONEY

# Declared, so that opening a table runs no job to find its columns.
SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}

DELIVERED_STATUS = "F"
PENDING_STATUS = "P"
UNTRANSLATED = ("Brand#9", "Brand#12", "Brand#14")
PROMISED_DAYS = 45


@dataclass(frozen=True)
class Star:
    spark: SparkSession
    folder: str

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder.rstrip('/')}/{name}.parquet"
        return self.spark.read.schema(SCHEMAS[name]).parquet(path)

    @staticmethod
    def _some(df: DataFrame, rows: Column | None) -> DataFrame:
        return df if rows is None else df.filter(rows)

    def orders(self) -> DataFrame:
        """Orders without delivery dates."""
        return self._orders(self.table("orders"), F.lit(None).cast("timestamp_ntz"))

    def shipped_orders(self) -> DataFrame:
        """Orders delivered with their last line, unless that line was shipped before the order."""
        last = self.table("lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last"))
        joined = self.table("orders").join(last, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        return self._orders(joined, F.when(F.col("last") >= F.col("o_orderdate"), F.col("last")))

    @staticmethod
    def _orders(df: DataFrame, delivered: Column) -> DataFrame:
        return df.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            F.col("o_orderdate").alias("order_approved_at"),
            F.lit(None).cast("timestamp_ntz").alias("order_delivered_carrier_date"),
            delivered.alias("order_delivered_customer_date"),
            (F.col("o_orderdate") + F.expr(f"INTERVAL '{PROMISED_DAYS}' DAY")).alias(
                "order_estimated_delivery_date"
            ),
        )

    def order_items(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").cast("smallint").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.col("l_extendedprice").cast(MONEY).alias("price"),
            F.col("l_tax").cast(MONEY).alias("freight_value"),
        )

    def order_payments(self) -> DataFrame:
        """One payment per purchase event."""
        bought = self.table("events").filter(F.col("event_type") == "purchase")
        return bought.select(
            self._event_order().alias("order_id"),
            (F.col("event_id") % 2 + 1).cast("int").alias("payment_sequential"),
            F.col("event_type").alias("payment_type"),
            F.lit(1).alias("payment_installments"),
            F.col("value").cast(MONEY).alias("payment_value"),
        )

    def order_reviews(self) -> DataFrame:
        """Two reviews for each order an event refers to; failed events were never answered."""
        answered = F.when(F.col("event_type") != "error", F.col("ts"))
        return self.table("events").select(
            F.col("event_id").alias("review_id"),
            self._event_order().alias("order_id"),
            (F.floor("value") % 5 + 1).cast("smallint").alias("review_score"),
            F.col("event_type").alias("review_comment_title"),
            F.col("props").alias("review_comment_message"),
            F.col("ts").alias("review_creation_date"),
            answered.alias("review_answer_timestamp"),
        )

    @staticmethod
    def _event_order() -> Column:
        return F.floor(F.col("event_id") / 2).cast("bigint")

    def products(self, rows: Column | None = None) -> DataFrame:
        return self._some(self.table("part"), rows).select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_brand").alias("product_category_name"),
            F.length("p_name").cast("smallint").alias("product_name_lenght"),
            F.length("p_type").cast("smallint").alias("product_description_lenght"),
            F.lit(None).cast("smallint").alias("product_photos_qty"),
            F.col("p_size").alias("product_weight_g"),
            *[
                F.col("p_size").cast("smallint").alias(f"product_{side}_cm")
                for side in ("length", "height", "width")
            ],
        )

    def translation(self) -> DataFrame:
        """Every category, under its own name."""
        return (
            self.table("part")
            .select(
                F.col("p_brand").alias("product_category_name"),
                F.col("p_brand").alias("product_category_name_english"),
            )
            .distinct()
        )

    def _placed(self, table: str, nation_key: str) -> DataFrame:
        """Rows of `table` with nation number, nation name and a state code by that number."""
        codes = F.array(*[F.lit(code) for code in STATE_NAMES])
        nation = self.table("nation").select(
            "n_nationkey",
            F.col("n_nationkey").cast("string").alias("zip_code_prefix"),
            F.col("n_name").alias("city"),
            F.get(codes, F.col("n_nationkey")).alias("state"),
        )
        return self.table(table).join(nation, F.col(nation_key) == F.col("n_nationkey"))

    def customers(self, rows: Column | None = None) -> DataFrame:
        return self._some(self._placed("customer", "c_nationkey"), rows).select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_unique_id"),
            F.col("zip_code_prefix").alias("customer_zip_code_prefix"),
            F.col("city").alias("customer_city"),
            F.col("state").alias("customer_state"),
        )

    def customers_by_nation(self) -> DataFrame:
        """Customers with the name of their nation in place of a state code."""
        return self._placed("customer", "c_nationkey").select(
            F.col("c_custkey").alias("customer_id"), F.col("city").alias("customer_state")
        )

    def sellers(self, rows: Column | None = None) -> DataFrame:
        return self._some(self._placed("supplier", "s_nationkey"), rows).select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("zip_code_prefix").alias("seller_zip_code_prefix"),
            F.col("city").alias("seller_city"),
            F.col("state").alias("seller_state"),
        )

    def locations(self) -> DataFrame:
        """Sold lines as points: the supplier's number as place, price and quantity as position."""
        return self.table("lineitem").select(
            F.col("l_suppkey").cast("string").alias("geolocation_zip_code_prefix"),
            F.col("l_extendedprice").alias("geolocation_lat"),
            F.col("l_quantity").alias("geolocation_lng"),
            F.col("l_returnflag").alias("geolocation_city"),
            F.col("l_linestatus").alias("geolocation_state"),
        )

    # Parents with rows missing. The tables refer to no absent row, so these leave some out by what
    # the rows say, for the jobs that complete or check references.

    def closed(self, orders: DataFrame) -> DataFrame:
        """Orders without the pending ones."""
        return orders.filter(F.col("order_status") != PENDING_STATUS)

    def solvent_customers(self) -> DataFrame:
        return self.customers(F.col("c_acctbal") >= 0)

    def solvent_sellers(self) -> DataFrame:
        return self.sellers(F.col("s_acctbal") >= 0)

    def listed_products(self) -> DataFrame:
        """Products without the economy line."""
        return self.products(F.col("p_type") != "ECONOMY")

    def partial_translation(self) -> DataFrame:
        """The categories that have an English name."""
        return self.translation().filter(~F.col("product_category_name").isin(*UNTRANSLATED))

    def debtor_locations(self) -> DataFrame:
        """Places of suppliers in debt: few enough to leave places of others unlisted."""
        return (
            self._placed("supplier", "s_nationkey")
            .filter(F.col("s_acctbal") < 0)
            .select(
                F.col("zip_code_prefix").alias("geolocation_zip_code_prefix"),
                F.col("s_acctbal").alias("geolocation_lat"),
                F.col("s_acctbal").alias("geolocation_lng"),
                F.col("city").alias("geolocation_city"),
                F.col("state").alias("geolocation_state"),
            )
        )
