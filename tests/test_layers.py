from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path
from threading import Barrier, Event

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feira.plans.marts import order_sales
from feira.plans.refresh import Layers, load_clean
from feira.sources.layers import (
    CatalogLayer,
    JdbcLayer,
    ParquetLayer,
    RangeSplit,
    prefix_conditions,
    unpad,
)
from feira.sources.scratch import keep, keep_all, new_path, scratch_of_run, shared_folder
from feira.specs import CLEAN, CLEAN_GEOLOCATION, MARTS, ORDER_ITEMS, ORDERS, RAW, SELLERS

from conftest import values

FIELDS = "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"


def test_overwrite_replaces_and_append_adds(spark, rows, tmp_path):
    layer = ParquetLayer(str(tmp_path))
    layer.write(rows(FIELDS, ("a", "1", "x", "SP"), ("b", "2", "y", "RJ")), SELLERS)
    layer.write(rows(FIELDS, ("c", "3", "z", "BA")), SELLERS)
    assert values(layer.read(spark, SELLERS), "seller_id") == [("c",)]
    layer.write(rows(FIELDS, ("d", "4", "w", "CE")), SELLERS, mode="append")
    assert values(layer.read(spark, SELLERS), "seller_id") == [("c",), ("d",)]


def test_tables_get_declared_columns_and_types(spark, tmp_path):
    df = spark.range(3).selectExpr(
        "'p' AS product_id", "id AS order_item_id", "cast(id AS string) AS order_id", "'s' AS seller_id",
        "cast(NULL AS timestamp_ntz) AS shipping_limit_date", "id / 3 AS price", "1 AS freight_value",
        "'not declared' AS extra",
    )
    layer = ParquetLayer(str(tmp_path))
    layer.write(df, ORDER_ITEMS)
    found = spark.read.parquet(layer.path(ORDER_ITEMS))
    assert found.schema.simpleString() == ORDER_ITEMS.schema.simpleString()
    assert [str(v) for (v,) in values(found, "price")] == ["0.00", "0.33", "0.67"]


def test_value_that_does_not_fit_stops_the_write(spark, tmp_path):
    df = spark.sql("SELECT 'o' order_id, 40000 order_item_id, 'p' product_id, 's' seller_id, "
                   "timestamp_ntz'2018-01-01' shipping_limit_date, 1 price, 1 freight_value")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        ParquetLayer(str(tmp_path)).write(df, ORDER_ITEMS)


def test_bucketed_tables_join_by_key_without_a_shuffle(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    layer = CatalogLayer("shop", "clean_", buckets=4)
    bought = "timestamp_ntz'2018-05-01'"
    orders = spark.range(400).selectExpr(
        "cast(id AS string) AS order_id", "cast(id % 30 AS string) AS customer_id",
        "if(id % 4 = 0, 'shipped', 'delivered') AS order_status", f"{bought} AS order_purchase_timestamp",
        *[f"cast(NULL AS timestamp_ntz) AS {c}" for c in ORDERS.names[4:]],
    )
    items = spark.range(2000).selectExpr(
        "cast(id % 500 AS string) AS order_id", "cast(id / 500 AS tinyint) AS order_item_id",
        "'p' AS product_id", "'s' AS seller_id", f"{bought} AS shipping_limit_date",
        "cast(id AS decimal(10,2)) AS price", "0 AS freight_value",
    )
    for _ in range(2):
        layer.write(orders, ORDERS)
        layer.write(items, ORDER_ITEMS)
    plain = order_sales(orders, items)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = order_sales(layer.read(spark, ORDERS), layer.read(spark, ORDER_ITEMS))
        plan = stored._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan.split("Subquery")[0]
        assert plan.count("hashpartitioning") == 0
        assert values(stored) == values(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_failed_overwrite_leaves_the_old_table(spark, rows, tmp_path):
    layer = ParquetLayer(str(tmp_path))
    layer.write(rows(FIELDS, ("a", "1", "x", "SP")), SELLERS)
    broken = rows(FIELDS, ("b", "2", "y", "RJ")).withColumn("seller_city", F.raise_error(F.lit("no city")))
    with pytest.raises(Exception, match="no city"):
        layer.write(broken, SELLERS)
    assert values(layer.read(spark, SELLERS), "seller_id") == [("a",)]
    assert [p.name for p in tmp_path.iterdir()] == ["sellers"]


def test_orders_outside_a_window_are_in_other_files(spark, tmp_path):
    orders = spark.range(4000).selectExpr(
        "cast(id AS string) AS order_id", "'c' AS customer_id", "'shipped' AS order_status",
        "if(id % 4 = 0, NULL, timestamp_ntz'2018-01-01' + make_dt_interval(pmod(xxhash64(id), 400))) "
        "AS order_purchase_timestamp",
        *[f"cast(NULL AS timestamp_ntz) AS {c}" for c in ORDERS.names[4:]],
    )
    layer = ParquetLayer(str(tmp_path))
    # Files of a size that AQE would merge.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    layer.write(orders, ORDERS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = layer.read(spark, ORDERS).groupBy(F.input_file_name()).agg(
        F.min("order_purchase_timestamp").alias("low"), F.max("order_purchase_timestamp").alias("high"),
        F.count("*").alias("n"),
    ).collect()
    spans = sorted((f.low, f.high) for f in files if f.low)
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert max(f.n for f in files) < 2000


class Reader:
    """As much of a session's reader as `JdbcLayer` uses; keeps what it was asked for."""

    def __init__(self, spark, asked):
        self.spark, self.asked, self.chosen = spark, asked, {}

    def format(self, name):
        return self

    def options(self, **chosen):
        self.chosen = chosen
        return self

    def load(self):
        return self._table(self.chosen["dbtable"], self.chosen)

    def jdbc(self, url, table, predicates, properties):
        return self._table(table, {"predicates": predicates})

    def _table(self, name, chosen):
        self.asked[name] = chosen
        spec = next(s for s in RAW if f"raw_{s.name}" == name)
        return self.spark.createDataFrame([], spec.schema)


class Stub:
    """A session whose reader is a stub and that is real otherwise."""

    def __init__(self, spark, asked):
        self._real, self.read = spark, Reader(spark, asked)

    def __getattr__(self, name):
        return getattr(self._real, name)


def test_splits_reach_the_reader_through_the_pipeline(spark, tmp_path):
    asked = {}
    raw = JdbcLayer("jdbc:x", "raw_", splits={
        "orders": RangeSplit("order_purchase_timestamp", "2016-01-01", "2019-01-01", 36),
        "order_items": prefix_conditions("order_id"),
    })

    class Raw:
        read = staticmethod(lambda session, spec: raw.read(Stub(session, asked), spec))

    root = Layers.parquet(str(tmp_path))
    load_clean(spark, Layers(Raw, root.clean, root.marts))
    assert set(asked) == {f"raw_{spec.name}" for spec in RAW}
    assert asked["raw_orders"]["numPartitions"] == "36"
    assert len(asked["raw_order_items"]["predicates"]) == 16
    assert "partitionColumn" not in asked["raw_sellers"]


def test_writers_by_table():
    layer = JdbcLayer("jdbc:x", writers=4, table_writers={"orders": 32})
    assert layer.write_options(ORDERS, "append")["numPartitions"] == "32"
    assert layer.write_options(SELLERS, "append")["numPartitions"] == "4"


class Session:
    """As much of a session as `shared_folder` reads."""

    def __init__(self, **settings):
        self.conf = {key.replace("_", "."): value for key, value in settings.items()}


def test_shared_folder_comes_from_the_session():
    named = Session(spark_checkpoint_dir="s3a://shared/checkpoints/", spark_master="yarn")
    assert shared_folder(named) == "s3a://shared/checkpoints"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session(spark_master="yarn"))
    local = Session(spark_master="local[4]")
    assert shared_folder(local) == shared_folder(local) != ""


def test_kept_table_is_in_the_shared_folder(spark):
    kept = keep(spark.range(5), "five")
    assert values(kept) == [(i,) for i in range(5)]
    assert all(shared_folder(spark) in path for path in kept.inputFiles())


# No database runs in these tests: the JDBC layer is checked up to the options it hands to Spark.


def test_jdbc_read_options():
    layer = JdbcLayer("jdbc:x", "raw_", options={"user": "u", "driver": "d"})
    whole = layer.read_options(ORDERS)
    assert whole["dbtable"] == "raw_orders" and whole["user"] == "u" and "partitionColumn" not in whole
    split = RangeSplit("order_purchase_timestamp", "2016-01-01", "2019-01-01", 36)
    assert layer.read_options(ORDERS, split).items() >= {
        "partitionColumn": "order_purchase_timestamp",
        "lowerBound": "2016-01-01",
        "upperBound": "2019-01-01",
        "numPartitions": "36",
    }.items()


def test_jdbc_write_options():
    layer = JdbcLayer("jdbc:x", "clean_", declared_types=True, options={"password": "secret"}, writers=4)
    options = layer.write_options(CLEAN_GEOLOCATION, "overwrite")
    assert options["truncate"] == "true" and options["numPartitions"] == "4"
    assert options["createTableColumnTypes"] == (
        "geolocation_id BIGINT, geolocation_zip_code_prefix CHAR(5), geolocation_lat DOUBLE, "
        "geolocation_lng DOUBLE, geolocation_city VARCHAR(40), geolocation_state CHAR(2)"
    )
    assert "truncate" not in layer.write_options(CLEAN_GEOLOCATION, "append")
    assert "createTableColumnTypes" not in JdbcLayer("jdbc:x", "raw_").write_options(ORDERS, "overwrite")
    assert "secret" not in repr(layer)


@pytest.mark.parametrize("spec", CLEAN + MARTS, ids=lambda spec: spec.name)
def test_declared_types_are_known_to_spark(spark, spec):
    assert StructType.fromDDL(spec.column_types).names == spec.names


def test_padded_keys_are_unpadded(rows):
    padded = rows(FIELDS, ("a" + " " * 31, "01   ", "x  ", "SP"), (None, None, None, None))
    assert values(unpad(padded, SELLERS)) == [("a", "01", "x  ", "SP"), (None, None, None, None)]


def test_prefix_conditions_take_every_row_once(spark):
    ids = spark.range(500).selectExpr("if(id % 50 = 0, NULL, sha1(cast(id AS string))) AS k")
    ids = ids.union(spark.sql("SELECT * FROM VALUES (''), ('Z'), ('zz'), ('0'), ('f') AS t(k)"))
    parts = [ids.filter(condition).count() for condition in prefix_conditions("k")]
    assert len(parts) == 16 and sum(parts) == ids.count() and min(parts) > 10


def test_two_runs_side_by_side_have_folders_of_their_own(spark):
    """The first to end deletes nothing of the other, whose jobs in threads use its folder."""
    inside, ended = Barrier(2), Event()

    def run(first):
        with scratch_of_run(spark):
            kept = keep_all({"a": spark.range(3), "b": spark.range(4)})
            inside.wait(60)
            if not first:
                ended.wait(60)
            counts = {name: df.count() for name, df in kept.items()}
            folder = new_path(spark, "x").rpartition("/")[0]
        if first:
            ended.set()
        return folder, counts

    with ThreadPoolExecutor(2) as pool:
        (one, a), (two, b) = pool.map(run, (True, False))
    assert one != two and a == b == {"a": 3, "b": 4}
    assert "/run-" in one and not Path(one).exists() and not Path(two).exists()
