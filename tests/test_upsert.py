"""Changed rows in the place of old ones."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feira.operators.backfill import reference_counts, reference_name
from feira.plans.refresh import (
    COUNTS,
    Layers,
    RepeatedKeys,
    audit_references,
    load_clean,
    load_marts,
    load_raw,
    refresh,
    upsert_rows,
)
from feira.sources import layers as layers_module
from feira.sources.layers import ParquetLayer
from feira.specs import CLEAN, ORDERS, SELLERS

from conftest import values
from test_refresh import expected_marts, make_feed, marts, write_feed

FIELDS = "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"


def state_of(folder):
    return {p.name: p.stat().st_mtime_ns for p in Path(folder).glob("part-*")}


@pytest.fixture
def hundred(spark, tmp_path):
    """Sellers 0 to 99 in ten files of ten."""
    layer = ParquetLayer(str(tmp_path / "clean"))
    for i in range(10):
        layer.write(spark.range(i * 10, i * 10 + 10, 1, 1).selectExpr(
            "cast(id AS string) AS seller_id", "'1' AS seller_zip_code_prefix", "'old' AS seller_city", "'SP' AS seller_state"
        ), SELLERS, "append")
    return layer


def test_only_files_with_changed_keys_are_written(spark, hundred, rows):
    folder = hundred.path(SELLERS)
    before = state_of(folder)
    replaced = upsert_rows(hundred, rows(FIELDS, ("11", "2", "new", "RJ"), ("15", "2", "new", "RJ"), ("x", "3", "new", None)), SELLERS)
    after = state_of(folder)
    assert len(before) == 10 and len(replaced) == 1
    untouched = {name: at for name, at in before.items() if not replaced[0].endswith(name)}
    assert len(untouched) == 9 and untouched.items() <= after.items()
    assert not {Path(f).name for f in replaced} & after.keys()
    found = {r[0]: r[2] for r in hundred.read(spark, SELLERS).collect()}
    assert found == {str(i): "old" for i in range(100)} | {"11": "new", "15": "new", "x": "new"}
    assert hundred.read(spark, SELLERS).count() == 101
    assert [p.name for p in Path(hundred.root).iterdir()] == ["sellers"]


def test_nothing_and_first_rows(spark, rows, hundred, tmp_path):
    before = state_of(hundred.path(SELLERS))
    assert upsert_rows(hundred, rows(FIELDS), SELLERS) == []
    assert before.items() <= state_of(hundred.path(SELLERS)).items()
    fresh = ParquetLayer(str(tmp_path / "fresh"))
    assert upsert_rows(fresh, rows(FIELDS, ("a", "1", "x", "SP")), SELLERS) == []
    assert values(fresh.read(spark, SELLERS), "seller_id") == [("a",)]


@pytest.mark.parametrize("bad", [[("1", "9", "a", "SP"), ("1", "9", "b", "SP")], [(None, "9", "a", "SP")]])
def test_repeated_and_incomplete_keys_are_refused(spark, rows, hundred, bad):
    before = state_of(hundred.path(SELLERS))
    with pytest.raises(RepeatedKeys, match="sellers: 1 keys"):
        upsert_rows(hundred, rows(FIELDS, *bad), SELLERS)
    assert state_of(hundred.path(SELLERS)) == before


def test_a_key_that_fills_the_table_is_replaced_by_one_row(spark, rows, tmp_path):
    """Tables written with `on_violation="report"` may repeat a key."""
    layer = ParquetLayer(str(tmp_path))
    copies = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('s', id)) AS seller_id", "'1' AS seller_zip_code_prefix", "'old' AS seller_city", "'SP' AS seller_state"
    )
    layer.write(copies, SELLERS)
    upsert_rows(layer, rows(FIELDS, ("hot", "2", "new", "RJ")), SELLERS)
    found = layer.read(spark, SELLERS)
    assert found.count() == 2001
    assert values(found.filter("seller_id = 'hot'")) == [("hot", "2", "new", "RJ")]


@pytest.mark.parametrize("dies_at", ["plan", "delete", "first move", "second move"])
def test_an_update_that_dies_is_finished_or_dropped(spark, rows, hundred, monkeypatch, dies_at):
    real = {name: getattr(layers_module, name) for name in ("write_text", "delete", "move")}
    calls = {"move": 0}

    def dying(name):
        def call(*args):
            if name == "move":
                calls["move"] += 1
            at = {"write_text": "plan", "delete": "delete", "move": f"{['', 'first', 'second'][min(2, calls['move'])]} move"}[name]
            if at == dies_at:
                raise KeyboardInterrupt
            return real[name](*args)

        return call

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    new = rows(FIELDS, ("11", "2", "new", "RJ"), ("71", "2", "new", "RJ"), ("x", "3", "new", None))
    for name in real:
        monkeypatch.setattr(layers_module, name, dying(name))
    with pytest.raises(KeyboardInterrupt):
        upsert_rows(hundred, new, SELLERS)
    seen = [r[0] for r in hundred.read(spark, SELLERS).collect()]
    assert len(seen) == len(set(seen))
    monkeypatch.undo()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # The next writer carries the plan out, or finds none.
    upsert_rows(hundred, rows(FIELDS, ("99", "4", "newer", "BA")), SELLERS)
    found = {r[0]: r[2] for r in hundred.read(spark, SELLERS).collect()}
    changed = {} if dies_at == "plan" else {"11": "new", "71": "new", "x": "new"}
    assert found == {str(i): "old" for i in range(100)} | changed | {"99": "newer"}
    assert hundred.read(spark, SELLERS).count() == len(found)
    assert [p.name for p in Path(hundred.root).iterdir()] == ["sellers"]


def test_orders_that_are_delivered_later(spark, tmp_path):
    """A second feed with changed and new orders gives the marts of the feed that has them from the start."""
    first = make_feed(21)
    layers = Layers.parquet(str(tmp_path))
    write_feed(first, tmp_path)
    refresh(spark, str(tmp_path), layers)
    whole = make_feed(21)
    changed = whole["orders"][100:140]
    for row in changed:
        row["order_status"] = "delivered"
        row["order_delivered_customer_date"] = row["order_estimated_delivery_date"]
    extra = dict(changed[0], order_id="late1")
    item = dict(whole["order_items"][0], order_id="late1", order_item_id=9)
    whole["orders"].append(extra)
    whole["order_items"].append(item)
    second = {spec.source: [] for spec in CLEAN} | {"orders": [*changed, extra], "order_items": [item]}
    second = {name: second.get(name, []) for name in whole}
    write_feed(second, tmp_path)
    load_raw(spark, str(tmp_path), layers.raw)
    report = load_clean(spark, layers, mode="upsert")
    assert {r.violations for r in report.collect()} == {0}
    # The key counts, with what was replaced taken back, are those of the tables as they are.
    counted = layers.clean.read(spark, COUNTS).groupBy("reference", "keys").agg(F.sum("child_rows").alias("n"))
    for spec in CLEAN:
        names = [reference_name(spec, fk) for fk in spec.foreign_keys]
        if names:
            real = reference_counts(layers.clean.read(spark, spec), spec)
            assert values(counted.filter(F.col("reference").isin(names) & (F.col("n") != 0))) == values(real), spec.name
    audit = audit_references(spark, layers.clean)
    assert {r.violations for r in audit.collect()} == {0}
    read = {Path(file).parent.name for file in audit.inputFiles()}
    assert {"orders", "reference_counts"} < read
    assert not read & {"order_items", "order_payments", "order_reviews", "geolocation"}
    load_marts(spark, layers)
    found = marts(spark, layers)
    for name, expected in expected_marts(whole).items():
        assert found[name] == expected, name
    for spec in CLEAN:
        table = layers.clean.read(spark, spec)
        assert table.select(*spec.primary_key).distinct().count() == table.count(), spec.name
    orders = layers.clean.read(spark, ORDERS)
    assert orders.filter(F.col("order_id").isin([r["order_id"] for r in changed]) & (F.col("order_status") != "delivered")).isEmpty()
