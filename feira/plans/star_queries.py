"""Every job on the star-schema tables, by name."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feira.functions.ages import age_parts, age_sums, mean_age
from feira.operators.backfill import backfill, reference_counts, zip_dimension
from feira.operators.constraints import (
    constraint_report,
    foreign_key_violations,
    orphan_rows,
    primary_key_violations,
    repeated_keys,
    stored_reference_lines,
    width_violations,
)
from feira.operators.dense_id import numbered_geolocation, with_dense_id
from feira.operators.ordered_id import add_ordered, first_ids
from feira.operators.quarantine import REASONS, quarantine, rejected_rows
from feira.operators.recent import PURCHASED, recent, window_start
from feira.plans import marts
from feira.plans.daily import DailySums
from feira.plans.refresh import COUNTS, Layers, RepeatedKeys, append_rows, refresh, upsert_rows
from feira.plans.star import DELIVERED_STATUS, PENDING_STATUS, Star
from feira.sources.layers import ParquetLayer
from feira.sources.raw import UNREADABLE, drop_incomplete, read_checked, read_raw
from feira.sources.scratch import keep, new_path
from feira.specs import (
    CLEAN,
    MARTS,
    ORDER_ITEMS,
    ORDER_REVIEWS,
    ORDERS,
    RAW,
    SELLERS,
    TableSpec,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(job: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    QUERIES[job.__name__] = lambda spark, folder: job(Star(spark, folder))
    return job


# --- window and scalar steps


@query
def t1_window_start(star: Star) -> DataFrame:
    return window_start(star.orders())


@query
def p7_recent_orders(star: Star) -> DataFrame:
    return recent(star.orders()).select("order_id", "order_status", PURCHASED)


@query
def t2_age_parts(star: Star) -> DataFrame:
    orders = star.orders().select("order_id", PURCHASED)
    lines = star.order_items().select("order_id", F.col("shipping_limit_date").alias("moment"))
    events = star.order_reviews().select("order_id", F.col("review_creation_date").alias("moment"))
    both = lines.union(events).join(orders, "order_id")
    forth, back = (F.col("moment"), F.col(PURCHASED)), (F.col(PURCHASED), F.col("moment"))
    return both.select(
        "order_id",
        "moment",
        *[part.cast("bigint").alias(name) for name, part in age_parts(*forth).items()],
        *[part.cast("bigint").alias(f"back_{name}") for name, part in age_parts(*back).items()],
    )


@query
def t3_mean_age(star: Star) -> DataFrame:
    in_window = recent(star.shipped_orders())
    sums = in_window.agg(*age_sums(F.col("order_delivered_customer_date"), F.col(PURCHASED)))
    return sums.select(*[part.alias(name) for name, part in mean_age().items()])


@query
def na_drop_subset(star: Star) -> DataFrame:
    columns = ("review_id", "order_id", "review_creation_date", "review_answer_timestamp")
    return drop_incomplete(star.order_reviews(), ORDER_REVIEWS).select(*columns)


# --- marts


def _card(star: Star, orders: DataFrame) -> DataFrame:
    return marts.scorecard(orders, delivered=DELIVERED_STATUS)


def _sales(star: Star) -> DataFrame:
    return marts.order_sales(star.orders(), star.order_items(), delivered=DELIVERED_STATUS)


def _categories(star: Star, translation: DataFrame) -> DataFrame:
    scores = marts.review_scores(star.orders(), star.order_reviews(), delivered=DELIVERED_STATUS)
    return marts.category_sales(star.order_items(), scores, star.products(), translation)


def _plain(df: DataFrame) -> DataFrame:
    """Money as double and means rounded, to compare values across engines."""
    shown = {
        "total_sales": F.col("total_sales").cast("double"),
        "average_sales": F.round(F.col("average_sales").cast("double"), 4),
        "average_rating": F.round("average_rating", 6),
        "delivered_order_percentage": F.round("delivered_order_percentage", 9),
    }
    return df.select(*[shown[c].alias(c) if c in shown else F.col(c) for c in df.columns])


@query
def m1_total_order(star: Star) -> DataFrame:
    return marts.total_order(_card(star, star.orders()))


@query
def m2_delivered_pct(star: Star) -> DataFrame:
    return _plain(marts.successful_delivery_percentage(_card(star, star.orders())))


@query
def m2_delivered_pct_empty(star: Star) -> DataFrame:
    card = marts.scorecard(star.orders(), delivered="ZZ")
    return _plain(marts.successful_delivery_percentage(card))


@query
def m3_total_sales(star: Star) -> DataFrame:
    return _plain(marts.total_sales_of_delivered_order(_sales(star)))


@query
def m4_avg_sales(star: Star) -> DataFrame:
    return _plain(marts.average_sales_of_delivered_order(_sales(star)))


@query
def m5_sales_by_state(star: Star) -> DataFrame:
    customers = star.customers_by_nation()
    return _plain(marts.total_sales_of_delivered_order_per_state(_sales(star), customers))


@query
def m5_sales_by_state_named(star: Star) -> DataFrame:
    return _plain(marts.total_sales_of_delivered_order_per_state(_sales(star), star.customers()))


@query
def m6_avg_shipping(star: Star) -> DataFrame:
    return marts.average_shipping_duration(_card(star, star.shipped_orders()))


@query
def m7_lateness(star: Star) -> DataFrame:
    return marts.order_delivery_lateness(_card(star, star.shipped_orders()))


@query
def m8_top_categories(star: Star) -> DataFrame:
    return _plain(marts.top_product_category_by_sales(_categories(star, star.translation())))


@query
def m8_untranslated_group(star: Star) -> DataFrame:
    key = "product_category_name"
    translation = backfill(star.partial_translation(), [key], [(star.products(), [key])])
    return _plain(marts.top_product_category_by_sales(_categories(star, translation)))


@query
def w1_category_rank(star: Star) -> DataFrame:
    ranked = marts.ranked_categories(_categories(star, star.translation()))
    return _plain(ranked).withColumn("rank", F.col("rank").cast("bigint"))


@query
def s4_sql_on_tables(star: Star) -> DataFrame:
    """Orders and sales per status of the window, as SQL over the same frames."""
    return star.spark.sql(
        """
        WITH recent AS (
            SELECT order_id, order_status FROM {orders}
            WHERE order_purchase_timestamp >=
                (SELECT max(order_purchase_timestamp) FROM {orders}) - INTERVAL '6' MONTH
        ), sales AS (
            SELECT order_id, order_status, sum(price) AS sales
            FROM recent JOIN {items} USING (order_id) GROUP BY order_id, order_status
        )
        SELECT order_status, count(*) AS orders, cast(sum(sales) AS double) AS total_sales
        FROM sales GROUP BY order_status ORDER BY total_sales DESC
        """,
        orders=star.orders(),
        items=star.order_items(),
    )


# --- clean tables


@query
def c1_backfill_orders(star: Star) -> DataFrame:
    children = (star.order_items(), star.order_payments(), star.order_reviews())
    users = [(child, ["order_id"]) for child in children]
    return backfill(star.closed(star.orders()), ["order_id"], users).select(
        "order_id",
        F.col("customer_id").cast("string").alias("customer_id"),
        "order_status",
        PURCHASED,
        "order_estimated_delivery_date",
    )


@query
def c1_backfill_products(star: Star) -> DataFrame:
    users = [(star.order_items(), ["product_id"])]
    return backfill(star.listed_products(), ["product_id"], users).select(
        "product_id",
        "product_category_name",
        F.col("product_name_lenght").cast("double").alias("product_name_lenght"),
        F.col("product_weight_g").cast("double").alias("product_weight_g"),
    )


@query
def c1_backfill_sellers(star: Star) -> DataFrame:
    return backfill(star.solvent_sellers(), ["seller_id"], [(star.order_items(), ["seller_id"])])


@query
def c1_backfill_customers(star: Star) -> DataFrame:
    return backfill(star.solvent_customers(), ["customer_id"], [(star.orders(), ["customer_id"])])


@query
def c1_backfill_translation(star: Star) -> DataFrame:
    key = ["product_category_name"]
    return backfill(star.partial_translation(), key, [(star.products(), key)])


@query
def c1z_zip_dimension(star: Star) -> DataFrame:
    return zip_dimension(star.debtor_locations(), star.customers(), star.sellers())


@query
def a11_dedup_locations(star: Star) -> DataFrame:
    return star.locations().dropDuplicates()


@query
def c2_geo_surrogate_id(star: Star) -> DataFrame:
    return numbered_geolocation(star.locations())


@query
def c2_ordered_ids(star: Star) -> DataFrame:
    """Places in the order of their ids, after a third of them came late, some in gaps that have no room."""
    order = ["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state", "geolocation_lat", "geolocation_lng"]
    places = keep(star.locations().distinct().withColumn("part", F.pmod(F.xxhash64(*order[:2], order[3]), F.lit(9))), "places")
    parts = [places.filter(test).drop("part") for test in ("part < 6", "part = 6", "part > 6")]
    table = first_ids(parts[0], order, "geolocation_id", gap=4)
    for new in parts[1:]:
        table = keep(add_ordered(table, new, order, "geolocation_id", gap=4).drop("moved"), "places-with-ids")
    return with_dense_id(table, ["geolocation_id"], "position").drop("geolocation_id")


# --- constraints


@query
def c3_pk_violations(star: Star) -> DataFrame:
    return primary_key_violations(star.order_items(), ["order_id", "order_item_id"]).select(
        "order_id", F.col("order_item_id").cast("bigint").alias("order_item_id"), "copies"
    )


@query
def c3_fk_violations(star: Star) -> DataFrame:
    key = ["order_id"]
    return foreign_key_violations(star.order_items(), key, star.closed(star.orders()), key)


@query
def c3_fk_orphan_rows(star: Star) -> DataFrame:
    key = ["order_id"]
    rows = orphan_rows(star.order_items(), key, star.closed(star.orders()), key)
    return rows.select(
        "order_id",
        F.col("order_item_id").cast("bigint").alias("order_item_id"),
        "product_id",
        "seller_id",
        F.col("price").cast("double").alias("price"),
    )


@query
def c3_length_violations(star: Star) -> DataFrame:
    """Whole document texts against the width of a review message."""
    width = ORDER_REVIEWS.widths["review_comment_message"]
    texts = star.table("documents").select("doc_id", F.col("text").alias("review_comment_message"))
    wide = width_violations(texts, {"review_comment_message": width})
    return wide.select(
        "doc_id",
        F.length("review_comment_message").cast("bigint").alias("characters"),
        F.array_join("too_wide", ",").alias("too_wide"),
    )


def _incomplete_tables(star: Star) -> dict[str, DataFrame]:
    """All clean tables without stub rows, so that references break."""
    return {
        "orders": star.closed(star.orders()),
        "customers": star.solvent_customers(),
        "order_items": star.order_items(),
        "order_payments": star.order_payments(),
        "order_reviews": star.order_reviews(),
        "products": star.listed_products(),
        "sellers": star.solvent_sellers(),
        "product_category_name_translation": star.partial_translation(),
        "geolocation": numbered_geolocation(star.debtor_locations()),
        "zip": zip_dimension(star.debtor_locations(), star.customers(), star.sellers()),
    }


@query
def c3_constraint_report(star: Star) -> DataFrame:
    return constraint_report(_incomplete_tables(star), CLEAN)


@query
def c3_stored_key_counts(star: Star) -> DataFrame:
    """The references checked from key counts that three batches of child rows have added up, one of them taken back."""
    tables, layer = _incomplete_tables(star), ParquetLayer(new_path(star.spark, "layer"))
    batch = F.pmod(F.xxhash64(F.struct("*")), F.lit(3))
    children = [(spec, tables[spec.name]) for spec in CLEAN if spec.foreign_keys]
    layer.write(reduce(DataFrame.unionByName, [reference_counts(df.filter(batch == 0), spec) for spec, df in children]), COUNTS)
    for test, sign in ((batch == 1, 1), (batch == 0, 1), (batch == 2, 1), (batch == 0, -1)):
        parts = [reference_counts(df.filter(test), spec) for spec, df in children]
        added = reduce(DataFrame.unionByName, parts).withColumn("child_rows", F.col("child_rows") * sign)
        layer.write(added, COUNTS, "append")
    return stored_reference_lines(layer.read(star.spark, COUNTS), tables, CLEAN)


@query
def c3_quarantine(star: Star) -> DataFrame:
    """Every row that breaks a constraint or refers to one that does, with the names of what it breaks."""
    marked = quarantine(_incomplete_tables(star), CLEAN, keep=keep)
    rows = [
        rejected_rows(marked[spec.name]).select(
            F.lit(spec.name).alias("table_name"),
            F.concat_ws("/", *spec.primary_key).alias("row_key"),
            F.array_join(REASONS, ",").alias(REASONS),
        )
        for spec in CLEAN
    ]
    counts = [part.groupBy(*part.columns).agg(F.count("*").alias("rows")) for part in rows]
    return reduce(DataFrame.unionByName, counts)


# --- raw files and layers


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and doubled quotes, spaces and microseconds kept."""
    df.write.options(
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        timestampNTZFormat="yyyy-MM-dd HH:mm:ss.SSSSSS",
    ).csv(path)


def _through_csv(star: Star, df: DataFrame, spec: TableSpec) -> DataFrame:
    path = new_path(star.spark, f"csv-{spec.name}")
    write_csv(df.select(*spec.names), path)
    return drop_incomplete(read_raw(star.spark, spec, path), spec)


@query
def r1_raw_orders(star: Star) -> DataFrame:
    return _through_csv(star, star.orders(), ORDERS).select(
        "order_id", "customer_id", "order_status", PURCHASED, "order_estimated_delivery_date"
    )


@query
def r1_raw_order_items(star: Star) -> DataFrame:
    raw = _through_csv(star, star.order_items(), ORDER_ITEMS)
    return raw.select(
        "order_id",
        F.col("order_item_id").cast("bigint").alias("order_item_id"),
        "product_id",
        "seller_id",
        "shipping_limit_date",
        F.col("price").cast("double").alias("price"),
        F.col("freight_value").cast("double").alias("freight_value"),
    )


@query
def r1_raw_reviews_multiline(star: Star) -> DataFrame:
    """Document texts, line breaks and quotes included, as review messages of the order they share
    a number with. Pending orders were not answered, so their reviews fall out."""
    orders = star.orders()
    answered = F.when(F.col("order_status") != "P", F.col(PURCHASED))
    reviews = (
        star.table("documents")
        .join(orders, F.col("doc_id") == orders["order_id"])
        .select(
            F.col("doc_id").alias("review_id"),
            "order_id",
            (F.col("n_chars") % 5 + 1).alias("review_score"),
            F.concat_ws("/", "lang", "source").alias("review_comment_title"),
            F.col("text").alias("review_comment_message"),
            F.col(PURCHASED).alias("review_creation_date"),
            answered.alias("review_answer_timestamp"),
        )
    )
    raw = _through_csv(star, reviews, ORDER_REVIEWS)
    return raw.withColumn("review_score", F.col("review_score").cast("bigint"))


@query
def s2_multiline_in_splits(star: Star) -> DataFrame:
    """All document texts, twice over, as messages of reviews in files that Spark reads in many splits."""
    docs = star.table("documents")
    reviews = docs.select(
        F.col("doc_id").cast("string").alias("review_id"),
        F.col("source").alias("order_id"),
        (F.col("n_chars") % 5 + 1).alias("review_score"),
        F.col("text").alias("review_comment_title"),
        F.concat("text", F.lit('\n"'), "text", F.lit('"')).alias("review_comment_message"),
        *[(F.lit("2018-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins="doc_id")).alias(c) for c in ORDER_REVIEWS.required],
    )
    raw = _through_csv(star, reviews, ORDER_REVIEWS)
    return raw.select(
        "review_id",
        F.col("order_id").alias("source"),
        F.md5(F.encode("review_comment_title", "UTF-8")).alias("title_md5"),
        F.md5(F.encode("review_comment_message", "UTF-8")).alias("message_md5"),
        "review_creation_date",
    )


@query
def r1_raw_awkward_values(star: Star) -> DataFrame:
    """Item numbers above 127, prices above eight digits, thirds of a cent, times in seven other formats."""
    kind, form = F.col("order_item_id") % 5, F.col("product_id") % 7
    price = F.col("price")
    formats = ("yyyy", "yyyy-MM", "yyyy-MM-dd'T'HH:mm:ss'+02:00'", "yyyy-MM-dd HH:mm:ss' Europe/Paris'",
               "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    other = F.date_format("shipping_limit_date", "dd/MM/yyyy HH:mm")
    for i, given in enumerate(formats, 1):
        other = F.when(form == i, F.date_format("shipping_limit_date", given)).otherwise(other)
    text = star.order_items().select(
        "order_id",
        F.when(kind == 0, 128).when(kind == 1, 300).otherwise(F.col("order_item_id")).alias("order_item_id"),
        "product_id",
        "seller_id",
        F.when(kind == 2, other)
        .otherwise(F.date_format("shipping_limit_date", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .alias("shipping_limit_date"),
        F.when(kind == 3, price + 1_000_000_000).otherwise(price).alias("price"),
        F.when(kind == 4, F.lit("12.345")).otherwise(F.col("freight_value").cast("string")).alias("freight_value"),
    )
    path = new_path(star.spark, "csv-awkward")
    write_csv(text, path)
    raw = read_checked(star.spark, ORDER_ITEMS, path)
    return raw.select(
        "order_id",
        F.col("order_item_id").cast("int").alias("order_item_id"),
        "shipping_limit_date",
        F.col("price").cast("double").alias("price"),
        F.array_join(UNREADABLE, ",").alias("unreadable"),
    )


@query
def k1_overwrite_layer(star: Star) -> DataFrame:
    layer = ParquetLayer(new_path(star.spark, "layer"))
    layer.write(star.sellers(), SELLERS)
    layer.write(star.solvent_sellers(), SELLERS)
    return layer.read(star.spark, SELLERS)


@query
def k2_append_layer(star: Star) -> DataFrame:
    layer = ParquetLayer(new_path(star.spark, "layer"))
    pending = star.orders().join(star.closed(star.orders()), "order_id", "left_anti")
    layer.write(star.closed(star.orders()), ORDERS)
    layer.write(pending, ORDERS, mode="append")
    return layer.read(star.spark, ORDERS).select("order_id", "customer_id", "order_status", PURCHASED)


@query
def k2_append_repeated_keys(star: Star) -> DataFrame:
    """An append of all orders to those that are not pending: the keys refused, the rows still there."""
    layer = ParquetLayer(new_path(star.spark, "layer"))
    layer.write(star.closed(star.orders()), ORDERS)
    incoming = star.orders().withColumn("order_id", F.col("order_id").cast("string"))
    present = layer.read(star.spark, ORDERS)
    try:
        append_rows(layer, incoming, ORDERS)
    except RepeatedKeys:
        pass
    count = layer.read(star.spark, ORDERS).agg(F.count("*").alias("n")).scalar()
    return repeated_keys(incoming, present, ["order_id"]).withColumn("rows_kept", count)


@query
def k2_upsert_layer(star: Star) -> DataFrame:
    """Pending orders arrive, and orders of every fifth customer that are there are delivered and move in time."""
    layer = ParquetLayer(new_path(star.spark, "layer"))
    orders = star.orders().withColumns({c: F.col(c).cast("string") for c in ("order_id", "customer_id")})
    layer.write(star.closed(orders), ORDERS)
    changed = orders.filter("customer_id % 5 = 0 OR order_status = 'P'").withColumns(
        {
            "order_status": F.when(F.col("order_status") == "P", F.lit("P")).otherwise(F.lit("F")),
            PURCHASED: F.col(PURCHASED) + F.expr("INTERVAL '1' HOUR"),
        }
    )
    upsert_rows(layer, changed, ORDERS)
    return layer.read(star.spark, ORDERS).select("order_id", "customer_id", "order_status", PURCHASED)


def raw_files(star: Star, folder: str) -> None:
    """All nine raw files, with parents missing from orders, customers, products and so on."""
    feed = {
        "customers": star.solvent_customers(),
        "geolocation": star.debtor_locations(),
        "order_items": star.order_items(),
        "order_payments": star.order_payments(),
        "order_reviews": star.order_reviews(),
        "orders": star.closed(star.shipped_orders()),
        "product_category_name_translation": star.partial_translation(),
        "products": star.listed_products(),
        "sellers": star.solvent_sellers(),
    }
    for spec in RAW:
        write_csv(feed[spec.name].select(*spec.names), f"{folder}/{spec.source}")


def _line(df: DataFrame, name: str, item, amount, rating=None) -> DataFrame:
    rating = F.lit(None).cast("double") if rating is None else rating
    return df.select(
        F.lit(name).alias("table_name"),
        item.cast("string").alias("item"),
        amount.cast("double").alias("amount"),
        F.round(rating, 6).alias("rating"),
    )


def mart_lines(found: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Every mart as rows (table_name, item, amount, rating)."""
    none = F.lit(None).cast("double")
    shown = {
        "total_order": (F.lit(""), F.col("count")),
        "successful_delivery_percentage": (F.lit(""), F.round("delivered_order_percentage", 9)),
        "total_sales_of_delivered_order": (F.lit(""), F.col("total_sales")),
        "average_sales_of_delivered_order": (F.lit(""), F.round(F.col("average_sales").cast("double"), 4)),
        "total_sales_of_delivered_order_per_state": (F.col("customer_state_name"), F.col("total_sales")),
        "average_shipping_duration": (F.col("average_shipping_time"), none),
        "order_delivery_lateness": (F.col("order_delivery"), F.col("count")),
        "top_product_category_by_sales": (
            F.col("product_category"),
            F.col("total_sales"),
            F.col("average_rating"),
        ),
    }
    return [_line(found[m.name], m.name, *shown[m.name]) for m in MARTS]


@query
def x1_refresh(star: Star) -> DataFrame:
    """Raw files to marts: the marts, the rows of each clean table, and the broken constraints.

    Lines of these tables repeat their key, so the constraints are reported, not enforced.
    """
    spark, folder = star.spark, new_path(star.spark, "star")
    raw_files(star, f"{folder}/files")
    layers = Layers.parquet(folder)
    report = refresh(spark, f"{folder}/files", layers, on_violation="report", delivered=DELIVERED_STATUS)

    parts = mart_lines({m.name: layers.marts.read(spark, m) for m in MARTS})
    for spec in CLEAN:
        count = layers.clean.read(spark, spec).agg(F.count("*").alias("n"))
        parts.append(_line(count, "clean", F.lit(spec.name), F.col("n")))
    broken = report.filter(F.col("violations") > 0)
    parts.append(_line(broken, "constraint_report", F.col("constraint_name"), F.col("violations")))
    return reduce(DataFrame.unionByName, parts)


@query
def m_daily_marts(star: Star) -> DataFrame:
    """All marts from sums per month, after two batches: late items and reviews, then pending and corrected orders."""
    daily = DailySums(new_path(star.spark, "daily"), delivered=DELIVERED_STATUS, unit="month")
    orders, items, reviews = keep(star.shipped_orders(), "shipped-orders"), star.order_items(), star.order_reviews()
    wrong, late = F.col("customer_id") % 7 == 0, (F.col("order_id") + F.col("order_item_id")) % 5 == 0
    status, bought = F.when(wrong, "O").otherwise(F.col("order_status")), F.col(PURCHASED) - F.expr("INTERVAL '30' HOUR")
    first = star.closed(orders).withColumns(
        {"order_status": status, PURCHASED: F.when(wrong, bought).otherwise(F.col(PURCHASED))}
    )
    lookups = {
        "customers": star.customers(),
        "products": star.products(),
        "product_category_name_translation": star.translation(),
    }
    early = {"orders": first, "order_items": items.filter(~late), "order_reviews": reviews.filter("review_id % 3 > 0")}
    daily.rebuild(star.spark, {**early, **lookups})
    added = {"order_items": items.filter(late), "order_reviews": reviews.filter("review_id % 3 = 0")}
    closed = star.closed(orders).select("order_id")
    daily.update(
        star.spark, {name: df.join(closed, "order_id", "left_semi") for name, df in added.items()}, lookups["customers"]
    )
    pending = orders.filter(wrong | (F.col("order_status") == PENDING_STATUS))
    opened = orders.filter(F.col("order_status") == PENDING_STATUS).select("order_id")
    batch = {
        "orders": pending,
        "order_items": items.join(opened, "order_id", "left_semi"),
        "order_reviews": reviews.join(opened, "order_id", "left_semi"),
    }
    daily.update(star.spark, batch, lookups["customers"])
    return reduce(DataFrame.unionByName, mart_lines(daily.marts(star.spark, lookups)))
