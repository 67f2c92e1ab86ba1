from __future__ import annotations

import zlib

import pytest

from conftest_llm import LONG
from feira.llm import sharding


@pytest.mark.parametrize("n", [1, 15, 16, 17, 500])
def test_shards(spark, documents, tmp_path, n):
    docs = documents(*[(i, f"text {i % 3 and i}") for i in range(n)])
    table = sharding.write_shards(docs, str(tmp_path / "s"), bucket_bytes=2000)
    found = sharding.digest(table).collect()
    assert sorted(r.doc_id for r in found) == list(range(n))
    slots = {}
    for r in found:
        text = f"text {r.doc_id % 3 and r.doc_id}".encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 1, zlib.crc32(text), "rows", None)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(i, [])) for i in range(16)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == n
    again = sharding.write_shards(docs.repartition(5), str(tmp_path / "t"), bucket_bytes=2000)
    place = lambda df: sorted((r.doc_id, r.shard, r.slot) for r in df.collect())
    assert place(table) == place(again)
    assert table.columns.count("shard") == 1 and set(docs.columns) <= set(table.columns)


def test_order_is_shuffled(documents, tmp_path):
    docs = documents(*[(i, "x") for i in range(2000)])
    rows = sharding.write_shards(docs, str(tmp_path / "s"), bucket_bytes=4000).collect()
    line = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    rising = sum(a < b for a, b in zip(line, line[1:]))
    assert 900 < rising < 1100
    other = sharding.write_shards(docs, str(tmp_path / "t"), seed=5, bucket_bytes=4000).collect()
    assert line != [r.doc_id for r in sorted(other, key=lambda r: (r.shard, r.slot))]


def test_awkward_rows(documents, tmp_path):
    docs = documents((None, "a"), (None, None), (1, ""), (2, LONG), (3, "é"), (3, "é"), (3, "f"))
    found = sharding.digest(sharding.write_shards(docs, str(tmp_path / "s"))).collect()
    assert sorted([(r.doc_id, r.size) for r in found], key=repr) == sorted(
        [(None, 2), (None, 1), (1, 1), (2, len(LONG) + 1), (3, 3), (3, 3), (3, 2)], key=repr
    )
    empty = documents((1, "x")).filter("false")
    assert sharding.digest(sharding.write_shards(empty, str(tmp_path / "e"))).count() == 0


def test_each_bucket_has_a_task(documents, tmp_path, spark):
    docs = documents(*[(i, "x" * 50) for i in range(300)])
    sharding.write_shards(docs, str(tmp_path / "s"), bucket_bytes=1 << 11)
    files = list((tmp_path / "s").rglob("part-*.parquet"))
    # A bucket lies in one shard or across the border of two.
    assert len(files) <= -(-300 * 51 // 2048) + 16


@pytest.mark.parametrize("row", [(None, None), (7, "same text")])
def test_equal_rows_spread_over_buckets(documents, tmp_path, row):
    docs = documents(*[(i, f"text {i}") for i in range(100, 400)], *[row] * 900)
    table = sharding.write_shards(docs, str(tmp_path / "s"), bucket_bytes=2000)
    found = table.select("doc_id", "text", "shard", "slot").collect()
    assert sum((r.doc_id, r.text) == row for r in found) == 900 and len(found) == 1200
    assert {r.doc_id for r in found} == {row[0], *range(100, 400)}
    assert sorted((r.shard, r.slot) for r in found) == [(s, i) for s in range(16) for i in range(75)]
    dealt, rows, buckets, repeated = sharding.dealt_rows(docs, "text", 2000, sharding.SEED)
    sizes = [r[0] for r in dealt.groupBy("bucket").agg({"copies": "sum"}).select("sum(copies)").collect()]
    assert (sum(sizes), rows, repeated) == (1200, 1200, True)
    assert max(sizes) < 3 * 1200 / buckets
    copies = [sum((r.doc_id, r.text) == row for r in found if r.shard == s) for s in range(16)]
    assert min(copies) > 0
    again = sharding.write_shards(docs.repartition(5), str(tmp_path / "t"), bucket_bytes=2000)
    place = lambda df: sorted([(r.doc_id, r.shard, r.slot) for r in df.collect()], key=repr)
    assert place(table) == place(again)


def test_rows_equal_in_key_and_text_keep_their_other_columns(spark, tmp_path):
    rows = [(None, None, f"s{i % 3}", (-0.0, 0.0)[i % 2]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, x double")
    table = sharding.write_shards(docs, str(tmp_path / "s"), bucket_bytes=2000)
    count = lambda found: sorted((r[0], str(r[1])) for r in found)
    assert count(table.select("source", "x").collect()) == count([r[2:] for r in rows])


def test_records_are_exchanged_once(spark, documents):
    """Also where no join may be a broadcast: what each bucket begins with travels with its records."""
    docs = documents(*[(i, f"text {i}") for i in range(200)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sharding.in_shards(docs, 16, 1, 2000)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Join" not in plan
    exchanges = [line for line in plan.splitlines() if "Exchange " in line]
    # The records; their number per bucket; one row per bucket.
    assert len(exchanges) == 3 and sum("REPARTITION_BY_NUM" in e or "direct" in e.lower() for e in exchanges) == 1, exchanges
