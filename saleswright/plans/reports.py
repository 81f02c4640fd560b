"""Parameterised queries. A parameter that is not given adds no filter to the plan."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.functions.scalar import contains_text, money, quotient, quotient_error
from saleswright.sources.tables import named_column, read_named_table

Price = int | float | Decimal


@dataclass(frozen=True)
class ProductColumns:
    """Names of the columns that the product reports read."""

    key: str = "Id"
    name: str = "ProductName"
    price: str = "UnitPrice"

    def listing(self, products: DataFrame) -> DataFrame:
        return products.select(self.key, self.name, money(self.price).alias("price"))


def product_list(
    products: DataFrame,
    columns: ProductColumns = ProductColumns(),
    min_price: Price | None = None,
    max_price: Price | None = None,
    name_part: str | None = None,
    ignore_case: bool = True,
    descending: bool = False,
) -> DataFrame:
    """Products within the limits given, by price; equal prices in order of key.

    The limits are compared with the stored column, so that they reach the scan.
    """
    if min_price is not None:
        products = products.filter(F.col(columns.price) >= F.lit(min_price))
    if max_price is not None:
        products = products.filter(F.col(columns.price) <= F.lit(max_price))
    if name_part is not None:
        products = products.filter(contains_text(columns.name, name_part, ignore_case))
    price = F.desc("price") if descending else F.asc("price")
    return columns.listing(products).orderBy(price, columns.key)


def product_list_up_to(
    products: DataFrame, max_price: Price, columns: ProductColumns = ProductColumns()
) -> DataFrame:
    """The same list as SQL with a named marker: the value is bound, not pasted in."""
    spark = products.sparkSession
    return spark.sql(
        """
        SELECT {key}, {name}, CAST({price} AS DECIMAL(12,2)) AS price
        FROM {products}
        WHERE {price} <= :max_price
        ORDER BY price, {key}
        """,
        args={"max_price": max_price},
        products=products,
        key=F.col(columns.key),
        name=F.col(columns.name),
        price=F.col(columns.price),
    )


def product_list_top(
    products: DataFrame,
    n: int = 1000,
    columns: ProductColumns = ProductColumns(),
    descending: bool = False,
) -> DataFrame:
    """The first ``n`` products by name, equal names in order of key."""
    name = F.desc(columns.name) if descending else F.asc(columns.name)
    return products.orderBy(name, columns.key).limit(n)


def products_at_price(
    products: DataFrame, price: Price, columns: ProductColumns = ProductColumns()
) -> DataFrame:
    """Products at one price, each with the number of products found.

    The count is a scalar subquery: a window would bring all products at the price to one task.
    """
    found = products.filter(F.col(columns.price) == F.lit(price))
    count = found.agg(F.count("*")).scalar()
    return columns.listing(found).select("*", count.alias("productcount"))


def top_by_column(df: DataFrame, n: int, column: str, key: str) -> DataFrame:
    """The ``n`` highest rows by a column named at run time, equal values in order of key."""
    return df.orderBy(named_column(df, column).desc(), named_column(df, key)).limit(n)


def query_top_x(spark: SparkSession, table: str, n: int, column: str, key: str) -> DataFrame:
    """``top_by_column`` of a table named at run time."""
    return top_by_column(read_named_table(spark, table), n, column, key)


def safe_divide(df: DataFrame, a: str, b: str, result: str = "result") -> DataFrame:
    """``a / b`` per row; a row that cannot be divided has NULL and an ``error_message``."""
    a_col, b_col = F.col(a), F.col(b)
    return df.withColumns(
        {result: quotient(a_col, b_col), "error_message": quotient_error(a_col, b_col)}
    )
