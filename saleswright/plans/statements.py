"""Several statements that follow one another: staged tables, held values, scripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.functions.scalar import money
from saleswright.functions.session_values import (
    divided_or_message,
    drop_value,
    hold_value,
    label_by_threshold,
)
from saleswright.plans.registry import query
from saleswright.session import scratch_path
from saleswright.sources.staged import cost_based_session, in_session, stage_analysed
from saleswright.sources.tables import read_table


def staged_names(spark: SparkSession, folder: str) -> dict[str, str]:
    """Lines, orders and the customers of one nation, staged with statistics: their table names."""
    mark = scratch_path(spark, "mark").rsplit("-", 1)[1]
    frames = {
        "line": read_table(spark, folder, "lineitem").select(
            "l_orderkey", money("l_extendedprice").alias("price")
        ),
        "order": read_table(spark, folder, "orders").select("o_orderkey", "o_custkey"),
        "customer": read_table(spark, folder, "customer")
        .filter("c_nationkey = 3")
        .select("c_custkey", "c_name"),
    }
    for name, df in frames.items():
        stage_analysed(df, f"staged_{name}_{mark}")
    return {name: f"staged_{name}_{mark}" for name in frames}


def sales_of_staged(session: SparkSession, names: dict[str, str]) -> DataFrame:
    """Sales per customer, joined from the largest table down."""
    line, order, customer = (in_session(session, names[n]) for n in ("line", "order", "customer"))
    return (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_custkey", "c_name")
        .agg(F.sum("price").cast("decimal(38,2)").alias("total"), F.count("*").alias("n"))
    )


@query(
    """
    SELECT c_custkey, c_name, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS total, count(*) AS n
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    WHERE c_nationkey = 3 GROUP BY c_custkey, c_name
    """
)
def staged_join_order(spark: SparkSession, folder: str) -> DataFrame:
    """Sales of one nation's customers from staged tables; the statistics let few orders, not all,
    meet the lines."""
    return sales_of_staged(cost_based_session(spark), staged_names(spark, folder))


@query(
    """
    SELECT p_partkey, p_name, CAST(p_retailprice AS DECIMAL(12,2)) AS price FROM part
    WHERE CAST(p_retailprice AS DECIMAL(12,2)) = (SELECT max(CAST(p_retailprice AS DECIMAL(12,2))) FROM part)
    """
)
def held_value(spark: SparkSession, folder: str) -> DataFrame:
    """The dearest parts, by a price that one statement looks up and the next one uses."""
    parts = read_table(spark, folder, "part").select("p_partkey", "p_name", money("p_retailprice").alias("price"))
    parts.createOrReplaceTempView("parts_to_look_up")
    dearest = hold_value(
        spark, "dearest_price", "DECIMAL(12,2)", "SELECT max(price) FROM parts_to_look_up"
    )
    # The value is taken into the plan here, so that the variable can go.
    found = spark.range(1).select(dearest.alias("v")).first()["v"]
    drop_value(spark, "dearest_price")
    return parts.filter(F.col("price") == F.lit(found))


_SALES_OF_1998 = """
    SELECT sum(CAST(o_totalprice AS DECIMAL(12,2))) FROM {} WHERE year(o_orderdate) = 1998
"""


@query(
    f"""
    SELECT CAST(value AS DECIMAL(38,2)) AS value,
           CASE WHEN value > 1000000 THEN 'greater' ELSE 'not greater' END AS label
    FROM ({_SALES_OF_1998.format("orders").replace("sum(CAST(o_totalprice AS DECIMAL(12,2)))", "sum(CAST(o_totalprice AS DECIMAL(12,2))) AS value")})
    """
)
def scripted_label(spark: SparkSession, folder: str) -> DataFrame:
    """The sales of a year and whether they are over a threshold, by an IF of a script."""
    read_table(spark, folder, "orders").createOrReplaceTempView("orders_to_label")
    query = _SALES_OF_1998.format("orders_to_label")
    return label_by_threshold(
        spark, query, "DECIMAL(38,2)", 1000000, "greater", "not greater"
    )


@query(
    """
    SELECT CASE WHEN d <> 0 THEN n / d END AS r,
           CASE WHEN d = 0 THEN 'divide by zero' END AS error_message
    FROM (SELECT CAST(count(*) AS DOUBLE) AS n, CAST(count_if(p_size > 1000) AS DOUBLE) AS d FROM part)
    """
)
def scripted_division(spark: SparkSession, folder: str) -> DataFrame:
    """Parts for each part of an impossible size: the division's error is caught by a handler."""
    read_table(spark, folder, "part").createOrReplaceTempView("parts_to_divide")
    return divided_or_message(
        spark,
        "SELECT count(*) FROM parts_to_divide",
        "SELECT count_if(p_size > 1000) FROM parts_to_divide",
        "divide by zero",
    )
