"""Reusable datasets. A view is a plan: the reader adds filters, groups and order.

The inputs come under these names: orders (order_id, order_date, customer_id), items (order_id,
line_id, product_id, quantity, unit_price) and products (product_id, product_name). The price is
the line's own. Totals need no more of a product than that there is one. For a year, lines are
summed per product first and only the sums meet the products.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswright.functions.scalar import mean


def sales_lines(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Every order line with its order and product, by two inner joins."""
    return items.join(orders, "order_id").join(products, "product_id")


def line_sale() -> Column:
    return (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)").alias("sales")


def salesday(lines: DataFrame, *extra: str) -> DataFrame:
    """Sales per line: year, month, day, product and quantity times line price."""
    return lines.select(
        F.year("order_date").alias("y"),
        F.month("order_date").alias("m"),
        F.dayofmonth("order_date").alias("d"),
        "product_id",
        "product_name",
        line_sale(),
        *extra,
    )


def salesday_with_customer(lines: DataFrame, customers: DataFrame, *names: str) -> DataFrame:
    """The same view with customer columns; customers come with a ``customer_id``."""
    return salesday(lines.join(customers, "customer_id"), *names)


def by_day(view: DataFrame) -> DataFrame:
    """The view by day, dearest line first.

    It comes with order_id and line_id, which order ties and spread a hot day, and drops them.
    """
    return view.orderBy(
        "y", "m", "d", F.desc("sales"), "product_id", "order_id", "line_id"
    ).drop("order_id", "line_id")


def _summed(
    orders: DataFrame, items: DataFrame, products: DataFrame, keys: dict[str, Column]
) -> DataFrame:
    """Sum and number of the sales per product and ``keys``, of products that exist."""
    lines = items.join(orders, "order_id").select("product_id", line_sale(), *_named(keys))
    summed = lines.groupBy("product_id", *keys).agg(
        F.sum("sales").alias("_total"), F.count("sales").alias("_n")
    )
    return summed.join(products.select("product_id"), "product_id")


def _named(keys: dict[str, Column]) -> list[Column]:
    return [column.alias(name) for name, column in keys.items()]


def sales_by_month(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines meet the products' keys and are summed once: a product sells too seldom in a month for
    sums per product to be fewer than its lines."""
    return (
        sales_lines(orders, items, products.select("product_id"))
        .select(F.year("order_date").alias("y"), F.month("order_date").alias("m"), line_sale())
        .groupBy("y", "m")
        .agg(F.sum("sales").cast("decimal(38,2)").alias("sales_month"))
    )


def mean_sale_by_year(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    return (
        _summed(orders, items, products, {"y": F.year("order_date")})
        .groupBy("y")
        .agg(F.sum("_total").alias("_total"), F.sum("_n").alias("_n"))
        .select("y", mean(F.col("_total"), F.col("_n")).alias("sales_avg"))
    )


def top_customers(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    names: list[str],
    n: int = 5,
) -> DataFrame:
    """The ``n`` customer names with the highest sales; equal totals in order of name.

    The lines meet the product keys alone and are summed per customer before the last join.
    """
    lines = sales_lines(orders, items, products.select("product_id"))
    per_customer = (
        lines.select("customer_id", line_sale())
        .groupBy("customer_id")
        .agg(F.sum("sales").alias("_sales"))
    )
    return (
        per_customer.join(customers, "customer_id")
        .groupBy(*names)
        .agg(F.sum("_sales").cast("decimal(38,2)").alias("total"))
        .orderBy(F.desc("total"), *names)
        .limit(n)
    )
