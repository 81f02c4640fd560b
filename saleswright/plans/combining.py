"""Joins, set operations and subqueries over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.functions.scalar import money
from saleswright.operators.aggregates import count_per_parent, total_per_name
from saleswright.operators.joins import (
    inner,
    outer_one_to_many,
    outer_where_null,
    with_match,
    without_match,
)
from saleswright.plans.registry import query
from saleswright.sources.tables import read_table

ORDER_CUSTOMER = [("o_custkey", "c_custkey")]
CUSTOMER_ORDER = [("c_custkey", "o_custkey")]


def _total() -> Column:
    return money("o_totalprice").alias("total")


@query(
    """
    SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS total, c_name
    FROM orders JOIN customer ON o_custkey = c_custkey
    """
)
def join_inner(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    customer = read_table(spark, folder, "customer")
    return inner(orders, customer, ORDER_CUSTOMER).select("o_orderkey", _total(), "c_name")


def _order_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = inner(
        read_table(spark, folder, "lineitem"),
        read_table(spark, folder, "orders"),
        [("l_orderkey", "o_orderkey")],
    )
    return inner(lines, read_table(spark, folder, "part"), [("l_partkey", "p_partkey")])


# An order's lines are sorted by line and part as well, so that a hot order can be spread.
LINE_ORDER = ["o_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    """
    SELECT o_orderkey, o_orderdate, p_name, CAST(l_quantity AS INT) AS qty,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS price
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
    """
)
def join_three_way(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _order_lines(spark, folder)
        .orderBy(*LINE_ORDER)
        .select(
            "o_orderkey",
            "o_orderdate",
            "p_name",
            F.col("l_quantity").cast("int").alias("qty"),
            money("l_extendedprice").alias("price"),
        )
    )


@query(
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt, p_name, CAST(l_quantity AS INT) AS qty,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS price
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
    """
)
def join_three_way_date(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _order_lines(spark, folder)
        .orderBy(*LINE_ORDER)
        .select(
            "o_orderkey",
            F.to_date("o_orderdate").alias("dt"),
            "p_name",
            F.col("l_quantity").cast("int").alias("qty"),
            money("l_extendedprice").alias("price"),
        )
    )


@query(
    """
    SELECT c_name, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_name
    """
)
def join_group_sum(spark: SparkSession, folder: str) -> DataFrame:
    totals = total_per_name(
        read_table(spark, folder, "orders"),
        read_table(spark, folder, "customer"),
        ORDER_CUSTOMER,
        ["c_name"],
        money("o_totalprice"),
        "total",
    )
    return totals.orderBy(F.desc("total"), "c_name")


@query(
    """
    SELECT c_custkey, c_name, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey, c_name
    """
)
def join_group_sum_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """The same per customer, so that customers of one name stay apart."""
    totals = total_per_name(
        read_table(spark, folder, "orders"),
        read_table(spark, folder, "customer"),
        ORDER_CUSTOMER,
        ["c_custkey", "c_name"],
        money("o_totalprice"),
        "total",
    )
    return totals.orderBy(F.desc("total"), "c_custkey")


@query(
    """
    SELECT c_custkey, o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS total
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P'
    """
)
def join_left(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer")
    pending = read_table(spark, folder, "orders").filter(F.col("o_orderstatus") == "P")
    return (
        outer_one_to_many(customer, pending, CUSTOMER_ORDER)
        .select("c_custkey", "o_orderkey", _total())
        .orderBy(F.asc_nulls_first("total"), "c_custkey", "o_orderkey")
    )


@query(
    """
    SELECT c_custkey, c_name, CAST(o_totalprice AS DECIMAL(12,2)) AS total
    FROM orders RIGHT JOIN customer ON o_custkey = c_custkey AND o_totalprice > 300000
    WHERE o_totalprice IS NULL
    """
)
def join_right_no_match(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer")
    large = read_table(spark, folder, "orders").filter(F.col("o_totalprice") > 300000)
    return outer_where_null(customer, large, CUSTOMER_ORDER, "o_totalprice").select(
        "c_custkey", "c_name", _total()
    )


@query(
    """
    SELECT c_custkey, c_name FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)
    """
)
def join_anti_no_match(spark: SparkSession, folder: str) -> DataFrame:
    """What the query above is meant to find: customers without such an order."""
    customer = read_table(spark, folder, "customer")
    large = read_table(spark, folder, "orders").filter(F.col("o_totalprice") > 300000)
    return without_match(customer, large, CUSTOMER_ORDER).select("c_custkey", "c_name")


@query(
    """
    SELECT 'Customer' AS type, c_name AS contact, c_nationkey AS nk FROM customer
    UNION SELECT 'Supplier', s_name, s_nationkey FROM supplier
    """
)
def union_distinct(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_table(spark, folder, "customer").select(
        F.lit("Customer").alias("type"),
        F.col("c_name").alias("contact"),
        F.col("c_nationkey").alias("nk"),
    )
    suppliers = read_table(spark, folder, "supplier").select(
        F.lit("Supplier"), "s_name", "s_nationkey"
    )
    return customers.union(suppliers).distinct()


@query(
    """
    SELECT c_nationkey AS nk, 'INS' AS op FROM customer
    UNION ALL SELECT s_nationkey, 'DEL' FROM supplier
    """
)
def union_all(spark: SparkSession, folder: str) -> DataFrame:
    customers = read_table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("nk"), F.lit("INS").alias("op")
    )
    suppliers = read_table(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("nk"), F.lit("DEL").alias("op")
    )
    return customers.unionByName(suppliers)


@query(
    """
    SELECT p_partkey, p_name FROM part
    WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)
    """
)
def in_subquery(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part").select("p_partkey", "p_name")
    large = read_table(spark, folder, "lineitem").filter(F.col("l_quantity") >= 50)
    return with_match(part, large, [("p_partkey", "l_partkey")])


@query(
    """
    SELECT c_custkey, (SELECT count(o_orderkey) FROM orders
                       WHERE o_custkey = c_custkey AND o_totalprice > 400000) AS order_count
    FROM customer
    """
)
def scalar_subquery_count(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer").select("c_custkey")
    large = read_table(spark, folder, "orders").filter(F.col("o_totalprice") > 400000)
    return count_per_parent(customer, large, CUSTOMER_ORDER, "o_orderkey", "order_count")


@query(
    """
    SELECT s_suppkey, s_name FROM supplier
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_extendedprice > 90000)
    """
)
def exists_subquery(spark: SparkSession, folder: str) -> DataFrame:
    supplier = read_table(spark, folder, "supplier").select("s_suppkey", "s_name")
    dear = read_table(spark, folder, "lineitem").filter(F.col("l_extendedprice") > 90000)
    return with_match(supplier, dear, [("s_suppkey", "l_suppkey")])
