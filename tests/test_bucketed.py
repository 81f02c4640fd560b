"""Tables bucketed together: plans without a shuffle, hot keys, and what is kept and dropped."""

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import plan, tuples
from saleswright.operators.hot_keys import hot_keys
from saleswright.plans.catalog import QUERIES
from saleswright.plans.layouts import bucketed_order_lines
from saleswright.sources.bucketed import (
    bucket_count,
    drop_co_bucketed,
    open_co_bucketed,
    write_co_bucketed,
)

PARENT, CHILD = {"p": "pk", "name": "name"}, {"c": "id", "fk": "fk"}


def frames(spark, hot=True, children=12000):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 90) if hot else F.col("id") % 90
    key = F.when(F.col("id") % 50 != 1, key)  # some without a parent's key
    child = spark.range(0, children, 1, 5).select("id", key.cast("long").alias("fk"))
    parent = spark.range(5, 80).select(F.col("id").alias("pk"), F.concat(F.lit("n"), "id").alias("name"))
    return parent, child


@pytest.fixture
def no_broadcast(set_conf):
    set_conf(
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1"
    )


@pytest.mark.parametrize("hot", [True, False])
def test_all_rows_are_kept_and_joined(spark, tmp_path, hot):
    parent, child = frames(spark, hot)
    base = f"{tmp_path}/t"
    for _ in range(2):  # a load that is repeated replaces itself
        tables = write_co_bucketed(parent, child, base, "pk", "fk", 4)
        assert sorted(tuples(tables.children()), key=str) == sorted(tuples(child), key=str)
        assert Counter(tuples(tables.parent)) == Counter(tuples(parent))
        assert tables.hot_child.count() == (child.filter("fk = 7").count() if hot else 0)
        plain = parent.join(child, F.col("pk") == F.col("fk")).select("pk", "name", "id", "fk")
        assert Counter(tuples(tables.joined(PARENT, CHILD).select("p", "name", "c", "fk"))) == Counter(tuples(plain))
    drop_co_bucketed(spark, base)


def test_the_join_shuffles_neither_table(spark, tmp_path, no_broadcast):
    parent, child = frames(spark, hot=False)
    tables = write_co_bucketed(parent, child, f"{tmp_path}/t", "pk", "fk", 4)
    joined = tables.parent.join(tables.child, F.col("pk") == F.col("fk"))
    assert "Exchange" not in plan(joined) and "SelectedBucketsCount: 4 out of 4" in plan(joined)
    plain = parent.join(child, F.col("pk") == F.col("fk"))
    assert plan(plain).count("Exchange hashpartitioning") == 2


def test_order_and_line_queries_shuffle_neither_orders_nor_lines(spark, data, set_conf):
    tables = bucketed_order_lines(spark, data)
    set_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(tables.joined({"k": "o_orderkey"}, {"part": "l_partkey"}))
    cold, hot = text.split("SortMergeJoin")[1:]
    assert cold.count("Bucketed: true") == 2 and "Exchange" not in cold
    assert "Bucketed: true" not in hot and hot.count("Exchange hashpartitioning") == 2


def test_buckets_are_sorted_files_of_their_own(spark, tmp_path):
    parent, child = frames(spark)
    write_co_bucketed(parent, child, f"{tmp_path}/t", "pk", "fk", 4)
    files = [f for f in os.listdir(f"{tmp_path}/t/child") if f.endswith(".parquet")]
    assert 1 < len(files) <= 4
    for name in files:
        keys = [r.fk for r in spark.read.parquet(f"{tmp_path}/t/child/{name}").collect()]
        assert keys == sorted(keys, key=lambda k: (k is not None, k or 0)) and 7 not in keys


def test_another_session_opens_the_files_again(spark, tmp_path, no_broadcast):
    parent, child = frames(spark)
    base = f"{tmp_path}/t"
    first = write_co_bucketed(parent, child, base, "pk", "fk", 4)
    wanted = Counter(tuples(first.joined(PARENT, CHILD)))
    drop_co_bucketed(spark, base)  # as if the catalogue had never known them
    again = open_co_bucketed(spark, base, "pk", "fk", 4)
    assert Counter(tuples(again.joined(PARENT, CHILD))) == wanted
    assert "Exchange" not in plan(again.parent.join(again.child, F.col("pk") == F.col("fk")))


def test_empty_tables_and_other_types(spark, tmp_path):
    parent, child = frames(spark)
    tables = write_co_bucketed(parent.limit(0), child.limit(0), f"{tmp_path}/t", "pk", "fk")
    assert tables.joined(PARENT, CHILD).count() == 0
    with pytest.raises(ValueError, match="one type"):
        write_co_bucketed(parent, child.withColumn("fk", F.col("fk").cast("int")), f"{tmp_path}/u", "pk", "fk")


def test_bucket_counts_are_powers_of_two():
    assert [bucket_count(n) for n in (0, 10**6, 17_000_000, 10**9)] == [8, 8, 16, 512]


def test_hot_keys_are_all_found_and_few(spark):
    rows = spark.range(100_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 10 = 1 THEN 'b' ELSE cast(id AS string) END AS k")
    found = hot_keys(rows, "k")
    assert set(found.counts) == {"a", "b"} and abs(found.counts["a"] - 33334) < 100 and found.rows == 100_000
    sliced = rows.groupBy("k").agg(F.max(found.slices(F.col("k"))).alias("n")).filter("n > 1").collect()
    assert {r.k: r.n for r in sliced}.keys() == {"a", "b"}
    assert hot_keys(spark.range(1000), "id").counts == {} and hot_keys(rows.limit(0), "k").counts == {}
    nulls = spark.range(20_000).selectExpr("if(id % 2 = 0, NULL, id) AS k")
    assert hot_keys(nulls, "k").counts == {}


@pytest.mark.parametrize("name", ["join_three_way", "view_salesday"])
def test_bucketed_queries_equal_the_plain_ones(spark, data, name):
    plain, bucketed = QUERIES[name](spark, data), QUERIES[f"{name}_bucketed"](spark, data)
    assert [tuple(r) for r in bucketed.collect()] == [tuple(r) for r in plain.collect()]
