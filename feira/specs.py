"""Declared tables: columns, keys, references and text widths, one place for every job."""

from __future__ import annotations

from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

MONEY = DecimalType(18, 2)
MONEY_SUM = DecimalType(28, 2)
MONEY_MEAN = DecimalType(32, 6)
# Sums over items and reviews of an order can exceed the other types where one order has many of both.
PAIRED_SUM = DecimalType(38, 2)
PAIRED_COUNT = DecimalType(20, 0)


@dataclass(frozen=True)
class Column:
    name: str
    type: DataType
    sql_type: str
    width: int | None = None


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    source: str | None = None
    multiline: bool = False
    required: tuple[str, ...] = ()
    sorted_by: tuple[str, ...] = ()
    # Only where the primary key bounds the rows per value, so that no bucket can grow hot.
    bucketed_by: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType([StructField(c.name, c.type, True) for c in self.columns])

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def widths(self) -> dict[str, int]:
        return {c.name: c.width for c in self.columns if c.width is not None}

    @property
    def column_types(self) -> str:
        """Column types for a table created over JDBC."""
        return ", ".join(f"{c.name} {c.sql_type}" for c in self.columns)


def char(name: str, width: int) -> Column:
    return Column(name, StringType(), f"CHAR({width})", width)


def varchar(name: str, width: int) -> Column:
    return Column(name, StringType(), f"VARCHAR({width})", width)


def money(name: str) -> Column:
    return Column(name, MONEY, MONEY.simpleString().upper())


def small(name: str) -> Column:
    return Column(name, ShortType(), "SMALLINT")


def whole(name: str) -> Column:
    return Column(name, IntegerType(), "INT")


def moment(name: str) -> Column:
    return Column(name, TimestampNTZType(), "TIMESTAMP")


def real(name: str) -> Column:
    return Column(name, DoubleType(), "DOUBLE")


def _zip_reference(*columns: str) -> ForeignKey:
    return ForeignKey(columns, "zip", ("zip_code_prefix", "zip_city", "zip_state"))


def _same_name(column: str, parent: str) -> ForeignKey:
    return ForeignKey((column,), parent, (column,))


# The data contract of the input files and tables (names, order, types, widths,
# keys). The spelling "lenght" is the files' own.
CUSTOMERS = TableSpec(
    "customers",
    (
        char("customer_id", 32),
        char("customer_unique_id", 32),
        char("customer_zip_code_prefix", 5),
        varchar("customer_city", 40),
        char("customer_state", 2),
    ),
    primary_key=("customer_id",),
    foreign_keys=(_zip_reference("customer_zip_code_prefix", "customer_city", "customer_state"),),
    source="customers_dataset.csv",
    bucketed_by=("customer_id",),
)
GEOLOCATION = TableSpec(
    "geolocation",
    (
        char("geolocation_zip_code_prefix", 5),
        real("geolocation_lat"),
        real("geolocation_lng"),
        varchar("geolocation_city", 40),
        char("geolocation_state", 2),
    ),
    source="geolocation_dataset.csv",
)
ORDER_ITEMS = TableSpec(
    "order_items",
    (
        char("order_id", 32),
        small("order_item_id"),
        char("product_id", 32),
        char("seller_id", 32),
        moment("shipping_limit_date"),
        money("price"),
        money("freight_value"),
    ),
    primary_key=("order_id", "order_item_id"),
    foreign_keys=(
        _same_name("order_id", "orders"),
        _same_name("product_id", "products"),
        _same_name("seller_id", "sellers"),
    ),
    source="order_items_dataset.csv",
    bucketed_by=("order_id",),
)
ORDER_PAYMENTS = TableSpec(
    "order_payments",
    (
        char("order_id", 32),
        whole("payment_sequential"),
        varchar("payment_type", 20),
        whole("payment_installments"),
        money("payment_value"),
    ),
    primary_key=("order_id", "payment_sequential"),
    foreign_keys=(_same_name("order_id", "orders"),),
    source="order_payments_dataset.csv",
    bucketed_by=("order_id",),
)
ORDER_REVIEWS = TableSpec(
    "order_reviews",
    (
        char("review_id", 32),
        char("order_id", 32),
        small("review_score"),
        varchar("review_comment_title", 255),
        varchar("review_comment_message", 255),
        moment("review_creation_date"),
        moment("review_answer_timestamp"),
    ),
    primary_key=("order_id", "review_id"),
    foreign_keys=(_same_name("order_id", "orders"),),
    source="order_reviews_dataset.csv",
    multiline=True,
    required=("review_creation_date", "review_answer_timestamp"),
)
ORDERS = TableSpec(
    "orders",
    (
        char("order_id", 32),
        char("customer_id", 32),
        varchar("order_status", 11),
        moment("order_purchase_timestamp"),
        moment("order_approved_at"),
        moment("order_delivered_carrier_date"),
        moment("order_delivered_customer_date"),
        moment("order_estimated_delivery_date"),
    ),
    primary_key=("order_id",),
    foreign_keys=(_same_name("customer_id", "customers"),),
    source="orders_dataset.csv",
    sorted_by=("order_purchase_timestamp",),
    bucketed_by=("order_id",),
)
TRANSLATION = TableSpec(
    "product_category_name_translation",
    (
        varchar("product_category_name", 50),
        varchar("product_category_name_english", 50),
    ),
    primary_key=("product_category_name",),
    source="product_category_name_translation.csv",
)
PRODUCTS = TableSpec(
    "products",
    (
        char("product_id", 32),
        varchar("product_category_name", 50),
        small("product_name_lenght"),
        small("product_description_lenght"),
        small("product_photos_qty"),
        whole("product_weight_g"),
        small("product_length_cm"),
        small("product_height_cm"),
        small("product_width_cm"),
    ),
    primary_key=("product_id",),
    foreign_keys=(_same_name("product_category_name", "product_category_name_translation"),),
    source="products_dataset.csv",
    bucketed_by=("product_id",),
)
SELLERS = TableSpec(
    "sellers",
    (
        char("seller_id", 32),
        char("seller_zip_code_prefix", 5),
        varchar("seller_city", 40),
        char("seller_state", 2),
    ),
    primary_key=("seller_id",),
    foreign_keys=(_zip_reference("seller_zip_code_prefix", "seller_city", "seller_state"),),
    source="sellers_dataset.csv",
    bucketed_by=("seller_id",),
)
ZIP = TableSpec(
    "zip",
    (
        char("zip_code_prefix", 5),
        varchar("zip_city", 40),
        char("zip_state", 2),
    ),
    primary_key=("zip_code_prefix", "zip_city", "zip_state"),
)
CLEAN_GEOLOCATION = TableSpec(
    "geolocation",
    (Column("geolocation_id", LongType(), "BIGINT"),) + GEOLOCATION.columns,
    primary_key=("geolocation_id",),
    foreign_keys=(
        _zip_reference("geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"),
    ),
)


def _counted(name: str) -> Column:
    return Column(name, LongType(), "BIGINT")


def _summed(name: str) -> Column:
    return Column(name, MONEY_SUM, MONEY_SUM.simpleString().upper())


# Names and columns of the result tables.
MARTS = (
    TableSpec("total_order", (_counted("count"),)),
    TableSpec("successful_delivery_percentage", (real("delivered_order_percentage"),)),
    TableSpec("total_sales_of_delivered_order", (_summed("total_sales"),)),
    TableSpec(
        "average_sales_of_delivered_order",
        (Column("average_sales", MONEY_MEAN, MONEY_MEAN.simpleString().upper()),),
    ),
    TableSpec(
        "total_sales_of_delivered_order_per_state",
        (char("customer_state", 2), _summed("total_sales"), varchar("customer_state_name", 20)),
    ),
    TableSpec("average_shipping_duration", (varchar("average_shipping_time", 16),)),
    TableSpec("order_delivery_lateness", (varchar("order_delivery", 10), _counted("count"))),
    TableSpec(
        "top_product_category_by_sales",
        (
            varchar("product_category", 50),
            Column("total_sales", PAIRED_SUM, PAIRED_SUM.simpleString().upper()),
            real("average_rating"),
        ),
    ),
)

RAW = (
    CUSTOMERS,
    GEOLOCATION,
    ORDER_ITEMS,
    ORDER_PAYMENTS,
    ORDER_REVIEWS,
    ORDERS,
    TRANSLATION,
    PRODUCTS,
    SELLERS,
)
CLEAN = tuple(CLEAN_GEOLOCATION if spec is GEOLOCATION else spec for spec in RAW) + (ZIP,)


def parents_first(specs: tuple[TableSpec, ...] = CLEAN) -> list[list[TableSpec]]:
    """The tables in groups to be loaded in turn: no table refers to its own or a later group."""
    by_name = {spec.name: spec for spec in specs}
    sorter = TopologicalSorter(
        {spec.name: [fk.parent for fk in spec.foreign_keys] for spec in specs}
    )
    sorter.prepare()
    groups = []
    while sorter.is_active():
        names = sorter.get_ready()
        groups.append([by_name[name] for name in sorted(names)])
        sorter.done(*names)
    return groups
