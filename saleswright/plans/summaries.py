"""Aggregates over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.functions.scalar import in_year, mean, money, money_sum
from saleswright.operators.aggregates import joined_in_parts, mean_per_name_between
from saleswright.plans.registry import query
from saleswright.sources.tables import read_table



def _total() -> Column:
    return money("o_totalprice")


@query("SELECT min(CAST(p_retailprice AS DECIMAL(12,2))) AS min_price FROM part")
def agg_min(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part")
    return part.agg(F.min(money("p_retailprice")).alias("min_price"))


@query(
    "SELECT max(CAST(o_totalprice AS DECIMAL(12,2))) AS max_total"
    " FROM orders WHERE year(o_orderdate) = 1998"
)
def agg_max_year(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    return orders.filter(in_year(orders, "o_orderdate", 1998)).agg(
        F.max(_total()).alias("max_total")
    )


@query("SELECT count(c_custkey) AS n FROM customer")
def agg_count(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").agg(F.count("c_custkey").alias("n"))


@query(
    """
    SELECT count(*) AS n, concat('The number of suppliers is ', CAST(count(*) AS VARCHAR)) AS msg
    FROM supplier
    """
)
def agg_count_star(spark: SparkSession, folder: str) -> DataFrame:
    message = F.concat(F.lit("The number of suppliers is "), F.col("n").cast("string"))
    counted = read_table(spark, folder, "supplier").agg(F.count("*").alias("n"))
    return counted.withColumn("msg", message)


@query(
    "SELECT sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total"
    " FROM orders WHERE year(o_orderdate) = 1997"
)
def agg_sum_year(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    of_year = orders.filter(in_year(orders, "o_orderdate", 1997))
    return of_year.agg(money_sum(_total()).alias("total"))


@query("SELECT round(avg(CAST(o_totalprice AS DECIMAL(12,2))), 4) AS media FROM orders")
def agg_avg(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").agg(
        mean(F.sum(_total()), F.count(_total())).alias("media")
    )


@query(
    """
    SELECT CAST(trunc(sum(CAST(CAST(l_quantity AS INT) * CAST(l_extendedprice AS DECIMAL(12,2))
                               AS DECIMAL(18,2)))) AS BIGINT) AS totalsales
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE year(o_orderdate) = 1998
    """
)
def agg_sum_expr_year(spark: SparkSession, folder: str) -> DataFrame:
    """The whole part of a year's sales, at the lines' own prices."""
    orders = read_table(spark, folder, "orders")
    of_year = orders.filter(in_year(orders, "o_orderdate", 1998)).select("o_orderkey")
    lines = read_table(spark, folder, "lineitem").join(
        of_year, F.col("l_orderkey") == F.col("o_orderkey")
    )
    sale = (F.col("l_quantity").cast("int") * money("l_extendedprice")).cast("decimal(18,2)")
    return lines.agg(F.sum(sale).cast("long").alias("totalsales"))


@query(
    """
    SELECT p_brand, p_partkey // 1000 AS part_no,
           string_agg(p_name, chr(10) ORDER BY p_partkey) AS all_names
    FROM part GROUP BY p_brand, p_partkey // 1000
    """
)
def agg_concat(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part")
    return joined_in_parts(part, ["p_brand"], "p_name", "p_partkey", 1000, "all_names")


@query("SELECT c_nationkey, count(c_custkey) AS n FROM customer GROUP BY c_nationkey")
def group_count(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer")
    return customer.groupBy("c_nationkey").agg(F.count("c_custkey").alias("n"))


@query(
    'SELECT count(c_custkey) AS "TotalCustomers", c_mktsegment AS "Segment"'
    " FROM customer GROUP BY c_mktsegment"
)
def group_count_alias(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer")
    return customer.groupBy(F.col("c_mktsegment").alias("Segment")).agg(
        F.count("c_custkey").alias("TotalCustomers")
    )


@query("SELECT count(c_custkey) AS n, c_nationkey FROM customer GROUP BY c_nationkey")
def group_count_sorted(spark: SparkSession, folder: str) -> DataFrame:
    return group_count(spark, folder).orderBy(F.desc("n"), "c_nationkey")


@query(
    """
    SELECT c_nationkey, count(c_custkey) AS qt FROM customer WHERE c_nationkey <> 0
    GROUP BY c_nationkey HAVING count(c_custkey) >= 60
    """
)
def having_count(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read_table(spark, folder, "customer")
        .filter(F.col("c_nationkey") != 0)
        .groupBy("c_nationkey")
        .agg(F.count("c_custkey").alias("qt"))
        .filter(F.col("qt") >= 60)
        .orderBy(F.desc("qt"), "c_nationkey")
    )


@query(
    """
    SELECT c_name, round(avg(CAST(o_totalprice AS DECIMAL(12,2))), 4) AS media
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_name
    HAVING avg(CAST(o_totalprice AS DECIMAL(12,2))) BETWEEN 245000 AND 255000
    """
)
def having_avg_between(spark: SparkSession, folder: str) -> DataFrame:
    return mean_per_name_between(
        read_table(spark, folder, "orders"),
        read_table(spark, folder, "customer"),
        [("o_custkey", "c_custkey")],
        ["c_name"],
        _total(),
        245000,
        255000,
        "media",
    )
