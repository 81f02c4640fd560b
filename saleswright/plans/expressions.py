"""Scalar expressions and functions over the test tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.functions.scalar import discounted, joined_text
from saleswright.functions.table_functions import (
    products_by_status,
    register_discount,
    register_products_by_status,
)
from saleswright.plans.registry import query
from saleswright.sources.tables import read_table, stage_for_session


@query(
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m,
           CAST(day(o_orderdate) AS INT) AS d
    FROM orders
    """
)
def fn_date_parts(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").alias("y"),
        F.month("o_orderdate").alias("m"),
        F.dayofmonth("o_orderdate").alias("d"),
    )


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dt FROM orders")
def fn_convert_date(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("dt")
    )


@query("SELECT o_orderkey, TIMESTAMP '2024-05-06 07:08:09' AS loaded_at FROM orders")
def fn_now(spark: SparkSession, folder: str) -> DataFrame:
    """The stamp as a parameter; ``schemas.now`` is the running clock in its place."""
    stamp = F.lit(datetime(2024, 5, 6, 7, 8, 9).isoformat()).cast("timestamp_ntz")
    return read_table(spark, folder, "orders").select("o_orderkey", stamp.alias("loaded_at"))


@query("SELECT p_partkey, CAST(p_size AS VARCHAR) AS size_text FROM part")
def fn_cast_text(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        "p_partkey", F.col("p_size").cast("string").alias("size_text")
    )


@query("SELECT p_partkey, concat(p_brand, ' ', p_name) AS label FROM part")
def fn_concat(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        "p_partkey", joined_text("p_brand", "p_name").alias("label")
    )


@query("SELECT p_partkey, substring(p_name, 1, 5) AS l FROM part")
def fn_left(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        "p_partkey", F.left("p_name", F.lit(5)).alias("l")
    )


@query("SELECT c_custkey, substring(c_name, 11, 100) AS r FROM customer")
def fn_substring(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").select(
        "c_custkey", F.substring("c_name", 11, 100).alias("r")
    )


@query("SELECT p_partkey, concat(p_brand, chr(10), p_name) AS t FROM part")
def fn_char(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        "p_partkey", F.concat("p_brand", F.char(F.lit(10)), "p_name").alias("t")
    )


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CAST(CAST(l_quantity AS INT) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS v
    FROM lineitem
    """
)
def fn_arithmetic(spark: SparkSession, folder: str) -> DataFrame:
    product = F.col("l_quantity").cast("int") * F.col("l_discount").cast("decimal(4,2)")
    return read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", product.cast("decimal(12,2)").alias("v")
    )


@query("SELECT s_suppkey, 'Supplier' AS type FROM supplier")
def fn_literal_column(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "supplier").select(
        "s_suppkey", F.lit("Supplier").alias("type")
    )


@query('SELECT p_partkey, p_name AS "Product Name" FROM part')
def fn_alias_forms(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        "p_partkey", F.col("p_name").alias("Product Name")
    )


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CAST(CAST(l_quantity AS INT) * CAST(l_extendedprice AS DECIMAL(10,2))
                * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(10,2)) AS sale_value
    FROM lineitem
    """
)
def udf_discount(spark: SparkSession, folder: str) -> DataFrame:
    value = discounted("l_quantity", "l_extendedprice", "l_discount")
    return read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", value.alias("sale_value")
    )


@query(
    """
    SELECT l_orderkey,
           sum(CAST(CAST(l_quantity AS INT) * CAST(l_extendedprice AS DECIMAL(10,2))
                    * CAST(0.9 AS DECIMAL(4,2)) AS DECIMAL(10,2))) AS final_sale_value
    FROM lineitem GROUP BY l_orderkey
    """
)
def udf_discount_grouped(spark: SparkSession, folder: str) -> DataFrame:
    value = discounted("l_quantity", "l_extendedprice", F.lit("0.1"))
    return (
        read_table(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sum(value).cast("decimal(38,2)").alias("final_sale_value"))
        .orderBy(F.desc("final_sale_value"), "l_orderkey")
    )


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CAST(CAST(l_quantity AS INT) * CAST(l_extendedprice AS DECIMAL(10,2))
                * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(10,2)) AS sale_value
    FROM lineitem
    """
)
def udf_discount_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The discount as a function of SQL."""
    register_discount(spark)
    stage_for_session(read_table(spark, folder, "lineitem"), "lines")
    return spark.sql(
        """
        SELECT l_orderkey, l_linenumber,
               FuncDiscount(CAST(l_quantity AS INT), CAST(l_extendedprice AS DECIMAL(10,2)),
                            CAST(l_discount AS DECIMAL(4,2))) AS sale_value
        FROM lines
        """
    )


@query("SELECT p_partkey AS id, p_name AS product_name FROM part WHERE (p_size > 40) = true")
def udtf_products_by_status(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part")
    return products_by_status(part, True, F.col("p_size") > 40, "p_partkey", "p_name")


@query(
    "SELECT p_partkey AS id, p_name AS product_name FROM part WHERE (p_size > 40) = false"
)
def udtf_products_by_status_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The table function of SQL, over the parts under the product columns that it reads."""
    products = read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("Id"),
        F.col("p_name").alias("ProductName"),
        (F.col("p_size") > 40).alias("IsDiscontinued"),
    )
    stage_for_session(products, "part_as_product")
    register_products_by_status(spark, "part_as_product")
    return spark.sql("SELECT * FROM fn_get_products_by_status(false)")
