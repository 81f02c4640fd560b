"""Functions for SQL users, defined by SQL expressions so that Catalyst inlines them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.sources.tables import quoted_name


def products_by_status(
    products: DataFrame,
    discontinued: bool,
    flag: Column | None = None,
    key: str = "Id",
    name: str = "ProductName",
) -> DataFrame:
    """Keys and names of products in one status. ``flag`` defaults to ``IsDiscontinued``."""
    flag = F.col("IsDiscontinued") if flag is None else flag
    return products.filter(flag if discontinued else ~flag).select(
        F.col(key).alias("id"), F.col(name).alias("product_name")
    )


def register_discount(spark: SparkSession) -> None:
    """``FuncDiscount(qty, unit_price, discount)`` for SQL of this session."""
    spark.sql(
        """
        CREATE OR REPLACE TEMPORARY FUNCTION FuncDiscount(
            qty INT, unit_price DECIMAL(10,2), discount DECIMAL(4,2))
        RETURNS DECIMAL(10,2)
        RETURN CAST(qty * unit_price * (1 - discount) AS DECIMAL(10,2))
        """
    )


def register_products_by_status(spark: SparkSession, *product_table: str) -> None:
    """``fn_get_products_by_status(is_discontinued)`` over a table with the product columns."""
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION fn_get_products_by_status(is_discontinued BOOLEAN)
        RETURNS TABLE (id BIGINT, product_name STRING)
        RETURN SELECT Id, ProductName FROM {quoted_name(*product_table)}
               WHERE IsDiscontinued = fn_get_products_by_status.is_discontinued
        """
    )
