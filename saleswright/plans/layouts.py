"""The order and line queries over tables that were bucketed together on load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.functions.scalar import money
from saleswright.plans import views
from saleswright.plans.combining import LINE_ORDER
from saleswright.plans.registry import query
from saleswright.session import scratch_path
from saleswright.sources.bucketed import CoBucketed, write_co_bucketed
from saleswright.sources.tables import read_table


def bucketed_order_lines(spark: SparkSession, folder: str) -> CoBucketed:
    """The orders and their lines, loaded side by side."""
    return write_co_bucketed(
        read_table(spark, folder, "orders").select("o_orderkey", "o_orderdate"),
        read_table(spark, folder, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
        ),
        scratch_path(spark, "order-lines"),
        "o_orderkey",
        "l_orderkey",
    )


@query(
    """
    SELECT o_orderkey, o_orderdate, p_name, CAST(l_quantity AS INT) AS qty,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS price
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
    """
)
def join_three_way_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """As ``join_three_way``; no order and no line is shuffled to meet the other."""
    lines = bucketed_order_lines(spark, folder).joined(
        {"o_orderkey": "o_orderkey", "o_orderdate": "o_orderdate"},
        {c: c for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")},
    )
    part = read_table(spark, folder, "part").select("p_partkey", "p_name")
    return (
        lines.join(part, lines["l_partkey"] == part["p_partkey"])
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
    SELECT CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m,
           CAST(day(o_orderdate) AS INTEGER) AS d, l_partkey AS product_id, p_name AS product_name,
           CAST(CAST(l_quantity AS INT) * CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS sales
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
    """
)
def view_salesday_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The sales view over orders and lines that lie in buckets."""
    lines = bucketed_order_lines(spark, folder).joined(
        {"order_id": "o_orderkey", "order_date": "o_orderdate"},
        {
            "line_id": "l_linenumber",
            "product_id": "l_partkey",
            "quantity": "l_quantity",
            "unit_price": "l_extendedprice",
        },
    )
    lines = lines.withColumns(
        {"quantity": F.col("quantity").cast("int"), "unit_price": money("unit_price")}
    )
    products = read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")
    )
    view = views.salesday(lines.join(products, "product_id"), "order_id", "line_id")
    return views.by_day(view)
