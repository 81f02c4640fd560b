"""What the plans must hold or must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import plan
from saleswright.operators.joins import (
    inner,
    outer_one_to_many,
    outer_where_null,
    rows_with_match,
    rows_without_match,
    with_match,
    without_match,
)
from saleswright.operators.quality import orphans
from saleswright.plans.catalog import QUERIES
from saleswright.plans.views import by_day, sales_lines, salesday


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_workers_cross_joins_or_windows_over_rows(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    for operator in ("Python", "Arrow", "InPandas", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in text, operator
    # The one window adds up the row counts of partitions.
    if name in ("sort_asc", "sort_desc", "sort_multi", "assign_ids", "audit_schema"):
        assert re.findall(r"Window \[sum\((\w+)#", text) == ["_rows"]
    else:
        assert "Window" not in text


PUSHED = {
    "filter_eq": "EqualTo(c_mktsegment,BUILDING)",
    "filter_and": "EqualTo(c_mktsegment,BUILDING)",
    "filter_or": "Or(EqualTo(c_nationkey,3),EqualTo(c_nationkey,7))",
    "filter_not": "Not(EqualTo(c_mktsegment,BUILDING))",
    "filter_in": "In(s_nationkey, [1,2,3])",
    "filter_range_sorted": "GreaterThanOrEqual(o_totalprice,100000.0)",
    "filter_not_range_sorted": "LessThan(o_totalprice,100000.0)",
    "filter_between": "GreaterThanOrEqual(p_retailprice,911.0)",
    "filter_date_between": "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)",
    "filter_like_prefix": "StringStartsWith(p_name,re)",
    "filter_like_contains": "StringContains(s_name,03)",
    "filter_point_lookup": "EqualTo(p_partkey,1)",
    "filter_year_param": "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)",
    "agg_sum_year": "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)",
    "agg_sum_expr_year": "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)",
    "product_list_max": "LessThanOrEqual(p_retailprice,910.0)",
    "find_product_by_price": "EqualTo(p_retailprice,918.0)",
    "in_subquery": "GreaterThanOrEqual(l_quantity,50.0)",
    "udtf_products_by_status": "GreaterThan(p_size,40)",
}


@pytest.mark.parametrize("name", sorted(PUSHED))
def test_filters_reach_the_scan(spark, data, name, set_conf):
    set_conf(spark__sql__maxMetadataStringLength="2000")
    assert PUSHED[name] in plan(QUERIES[name](spark, data))


@pytest.mark.parametrize("name", ["top_n", "top_n_list", "query_top_x", "view_top_customers"])
def test_top_rows_without_a_full_sort(spark, data, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, data))


@pytest.mark.parametrize(
    "name, kind",
    [
        ("in_subquery", "LeftSemi"),
        ("exists_subquery", "LeftSemi"),
        ("join_anti_no_match", "LeftAnti"),
        ("check_foreign_key", "LeftAnti"),
        ("audit_ins_del", "LeftSemi"),
    ],
)
def test_join_kinds(spark, data, name, kind):
    assert kind in plan(QUERIES[name](spark, data))


def test_a_small_change_is_found_by_its_keys(spark, data):
    text = plan(QUERIES["audit_ins_del"](spark, data))
    # The snapshots themselves are not shuffled.
    assert text.count("BroadcastHashJoin") == 2
    assert "Exchange hashpartitioning" not in text


def test_scans_read_only_the_needed_columns(spark, data):
    text = plan(QUERIES["join_group_sum"](spark, data))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in text


def test_orders_are_summed_before_the_join(spark, data):
    text = plan(QUERIES["join_group_sum"](spark, data))
    join, partial = text.index("Join"), text.rindex("partial_sum")
    assert join < partial


# --- one key with a third of all rows -------------------------------------------------

HOT = 7


@pytest.fixture(scope="module")
def hot_tables(spark, tmp_path_factory):
    """30,000 child rows, a third of them for one parent, and 1,000 parents."""
    folder = tmp_path_factory.mktemp("hot")
    key = F.when(F.col("id") % 3 == 0, HOT).otherwise(F.col("id") % 900)
    spark.range(0, 30000, 1, 12).select(
        key.cast("long").alias("fk"),
        F.col("id").alias("child"),
        F.sha2(F.col("id").cast("string"), 512).alias("text"),
        F.when(F.col("id") % 11 != 0, F.col("id")).alias("amount"),
    ).write.parquet(f"{folder}/child")
    spark.range(0, 1000, 1, 4).select(
        F.col("id").alias("pk"), F.sha2(F.col("id").cast("string"), 512).alias("name")
    ).write.parquet(f"{folder}/parent")
    return spark.read.parquet(f"{folder}/child"), spark.read.parquet(f"{folder}/parent")


@pytest.fixture
def cluster_like(set_conf):
    """No broadcasts, and sizes at which this small data counts as large."""
    set_conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="128KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


def pairs(rows):
    return sorted((r.pk, -1 if r.child is None else r.child) for r in rows)


def final_plan(df):
    rows = df.collect()
    return rows, plan(df)


def test_inner_join_splits_the_hot_key(hot_tables, cluster_like):
    child, parent = hot_tables
    rows, text = final_plan(inner(child, parent, [("fk", "pk")]))
    assert len(rows) == 30000
    assert "skew=true" in text


def test_sales_view_splits_a_hot_order_and_a_hot_product(spark, cluster_like, tmp_path):
    filler = F.sha2(F.col("id").cast("string"), 512)
    hot = F.col("id") % 3
    spark.range(0, 30000, 1, 12).select(
        F.when(hot == 0, HOT).otherwise(F.col("id") % 900).cast("long").alias("order_id"),
        F.col("id").alias("line_id"),
        F.when(hot == 1, HOT).otherwise(F.col("id") % 700).cast("long").alias("product_id"),
        (F.col("id") % 9).cast("int").alias("quantity"),
        (F.rand(1) * 100).cast("decimal(12,2)").alias("unit_price"),
    ).write.parquet(f"{tmp_path}/items")
    spark.range(0, 1000, 1, 4).select(
        F.col("id").alias("order_id"),
        F.expr("timestamp_ntz'2013-01-01' + make_interval(0, 0, 0, int(id))").alias("order_date"),
        filler.alias("note"),
    ).write.parquet(f"{tmp_path}/orders")
    spark.range(0, 1000, 1, 4).select(
        F.col("id").alias("product_id"), filler.alias("product_name")
    ).write.parquet(f"{tmp_path}/products")
    frames = [spark.read.parquet(f"{tmp_path}/{n}") for n in ("orders", "items", "products")]
    view = by_day(salesday(sales_lines(*frames), "order_id", "line_id"))
    rows, text = final_plan(view)
    assert len(rows) == 30000
    final = text.split("Initial Plan")[0]
    assert final.count("skew=true") >= 2
    # The sort spreads the hot day, as its keys end in the line.
    sizes = view.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 30000
    assert max(sizes) < 30000 / 6


def test_orphans_splits_the_hot_key(hot_tables, cluster_like):
    child, parent = hot_tables
    rows, text = final_plan(orphans(child, parent.filter(f"pk != {HOT}"), [("fk", "pk")]))
    assert len(rows) == child.filter(f"fk = {HOT}").count()
    assert "skew=true" in text


@pytest.mark.parametrize("form", [rows_with_match, rows_without_match])
def test_matches_of_rows_split_the_hot_key(hot_tables, cluster_like, form):
    child, parent = hot_tables
    some = parent.filter("pk <> 8" if form is rows_with_match else f"pk <> {HOT}")
    rows, text = final_plan(form(child, some, [("fk", "pk")]))
    kind = "left_semi" if form is rows_with_match else "left_anti"
    plain = child.join(some, F.col("fk") == F.col("pk"), kind)
    assert len(rows) == plain.count()
    assert "skew=true" in text


def test_outer_join_splits_the_hot_key_where_the_plain_form_cannot(hot_tables, cluster_like):
    child, parent = hot_tables
    joined = outer_one_to_many(parent, child, [("pk", "fk")])
    rows, text = final_plan(joined)
    final = text.split("Initial Plan")[0]
    assert final.count("Scan parquet") == 2 and final.count("Exchange hashpartitioning") == 2
    assert re.search(r"Exchange hashpartitioning\(fk#\d+L, _part#\d+", final)
    plain = parent.join(child, F.col("pk") == F.col("fk"), "left")
    assert pairs(rows) == pairs(plain.collect())
    sizes = [
        max(df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())
        for df in (joined, plain)
    ]
    assert sizes[0] < 30000 / 6 and sizes[1] >= 10000


def test_outer_join_without_a_hot_key_is_the_plain_join(hot_tables, cluster_like):
    child, parent = hot_tables
    even = child.filter(f"fk <> {HOT}")
    rows, text = final_plan(outer_one_to_many(parent, even, [("pk", "fk")]))
    assert "_part" not in text and text.split("Initial Plan")[0].count("Scan parquet") == 2
    assert pairs(rows) == pairs(parent.join(even, F.col("pk") == F.col("fk"), "left").collect())


def test_outer_join_reads_each_table_once(spark, data, cluster_like):
    text = final_plan(QUERIES["join_left"](spark, data))[1].split("Initial Plan")[0]
    assert text.count("Scan parquet") == 2


def test_outer_where_null_equals_the_plain_form(hot_tables, cluster_like):
    child, parent = hot_tables
    found = outer_where_null(parent, child, [("pk", "fk")], "amount")
    plain = child.join(parent, F.col("pk") == F.col("fk"), "right").filter("amount IS NULL")
    assert pairs(found.collect()) == pairs(plain.collect())


@pytest.mark.parametrize("form, kind", [(with_match, "left_semi"), (without_match, "left_anti")])
def test_match_forms_shuffle_distinct_keys_only(hot_tables, cluster_like, form, kind):
    child, parent = hot_tables
    df = form(parent, child, [("pk", "fk")])
    rows, text = final_plan(df)
    assert re.search(r"HashAggregate\(keys=\[fk#\d+L\], functions=\[\]", text)
    plain = parent.join(child, F.col("pk") == F.col("fk"), kind)
    assert sorted(r.pk for r in rows) == sorted(r.pk for r in plain.collect())
