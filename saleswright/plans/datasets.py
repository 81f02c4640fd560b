"""Views and parameterised reports over the test tables."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.functions.scalar import money, quotient, quotient_error
from saleswright.operators.aggregates import threshold_label
from saleswright.plans.registry import query
from saleswright.plans.reports import (
    ProductColumns,
    product_list,
    product_list_up_to,
    products_at_price,
    query_top_x,
)
from saleswright.plans.views import (
    by_day,
    mean_sale_by_year,
    sales_by_month,
    sales_lines,
    salesday,
    salesday_with_customer,
    top_customers,
)
from saleswright.sources.tables import read_named_table, read_table, stage_for_session

PART = ProductColumns("p_partkey", "p_name", "p_retailprice")

# --- views ----------------------------------------------------------------------------

SALESDAY_SQL = """
    SELECT CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m,
           CAST(day(o_orderdate) AS INT) AS d, p_partkey, p_name,
           CAST(CAST(l_quantity AS INT) * CAST(l_extendedprice AS DECIMAL(12,2))
                AS DECIMAL(18,2)) AS sales
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
"""
SALESDAY_CUSTOMER_SQL = """
    SELECT CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m,
           CAST(day(o_orderdate) AS INT) AS d, p_partkey, p_name,
           CAST(CAST(l_quantity AS INT) * CAST(l_extendedprice AS DECIMAL(12,2))
                AS DECIMAL(18,2)) AS sales, c_name
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
         JOIN customer ON c_custkey = o_custkey
"""


def _sales(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders, lines and products. ``l_extendedprice`` stands for the line's own unit price, which
    need not be the product's."""
    orders = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_custkey").alias("customer_id"),
    )
    items = read_table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("unit_price"),
    )
    products = read_table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")
    )
    return orders, items, products


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return sales_lines(*_sales(spark, folder))


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), "c_name"
    )


def _named(view: DataFrame) -> DataFrame:
    return view.withColumnsRenamed({"product_id": "p_partkey", "product_name": "p_name"})


@query("SELECT * FROM customer WHERE c_nationkey = 3")
def view_filtered(spark: SparkSession, folder: str) -> DataFrame:
    shown = read_table(spark, folder, "customer").filter(F.col("c_nationkey") == 3)
    return stage_for_session(shown, "customers_of_nation")


@query(SALESDAY_SQL)
def view_salesday(spark: SparkSession, folder: str) -> DataFrame:
    view = salesday(_lines(spark, folder), "order_id", "line_id")
    return _named(by_day(stage_for_session(view, "salesday")))


@query(f"SELECT y, m, sum(sales) AS sales_month FROM ({SALESDAY_SQL}) GROUP BY y, m")
def view_sales_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return sales_by_month(*_sales(spark, folder)).orderBy("y", "m")


@query(f"SELECT y, round(avg(sales), 4) AS sales_avg FROM ({SALESDAY_SQL}) GROUP BY y")
def view_avg_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return mean_sale_by_year(*_sales(spark, folder)).orderBy("y")


@query(SALESDAY_CUSTOMER_SQL)
def view_salesday_customer(spark: SparkSession, folder: str) -> DataFrame:
    view = salesday_with_customer(
        _lines(spark, folder), _customers(spark, folder), "c_name", "order_id", "line_id"
    )
    return _named(by_day(stage_for_session(view, "salesday")))


@query(
    f"""
    SELECT c_name, sum(sales) AS total FROM ({SALESDAY_CUSTOMER_SQL})
    GROUP BY c_name ORDER BY total DESC, c_name LIMIT 5
    """
)
def view_top_customers(spark: SparkSession, folder: str) -> DataFrame:
    return top_customers(*_sales(spark, folder), _customers(spark, folder), ["c_name"])


# --- reports --------------------------------------------------------------------------

LIST_SQL = "SELECT p_partkey, p_name, CAST(p_retailprice AS DECIMAL(12,2)) AS price FROM part"


@query(LIST_SQL, name="product_list")
def all_products(spark: SparkSession, folder: str) -> DataFrame:
    return product_list(read_table(spark, folder, "part"), PART, descending=True)


@query(f"{LIST_SQL} WHERE p_retailprice <= 910")
def product_list_max(spark: SparkSession, folder: str) -> DataFrame:
    return product_list_up_to(read_table(spark, folder, "part"), Decimal(910), PART)


@query(f"{LIST_SQL} WHERE p_retailprice >= 910 AND p_retailprice <= 920")
def product_list_min_max(spark: SparkSession, folder: str) -> DataFrame:
    return product_list(read_table(spark, folder, "part"), PART, min_price=910, max_price=920)


@query(f"{LIST_SQL} WHERE p_retailprice >= 910 AND p_retailprice <= 950 AND p_name ILIKE '%RIN%'")
def product_list_name(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part")
    return product_list(part, PART, min_price=910, max_price=950, name_part="RIN")


@query(f"{LIST_SQL} WHERE p_retailprice >= 0 AND p_retailprice <= 999999 AND p_name ILIKE '%gear%'")
def product_list_defaults(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part")
    return product_list(part, PART, min_price=0, max_price=999999, name_part="gear")


@query(
    f"{LIST_SQL} WHERE p_retailprice >= 970 AND (NULL IS NULL OR p_retailprice <= NULL)"
    " AND p_name ILIKE '%a%'"
)
def product_list_optional(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part")
    return product_list(part, PART, min_price=970, max_price=None, name_part="a")


@query(
    """
    SELECT p_partkey, p_name, CAST(p_retailprice AS DECIMAL(12,2)) AS price,
           count(*) OVER (PARTITION BY p_retailprice) AS productcount
    FROM part WHERE p_retailprice = 918
    """
)
def find_product_by_price(spark: SparkSession, folder: str) -> DataFrame:
    return products_at_price(read_table(spark, folder, "part"), 918, PART)


def _register(spark: SparkSession, folder: str, name: str) -> str:
    view = f"named_{name}"
    stage_for_session(read_table(spark, folder, name), view)
    return view


@query("SELECT * FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10", name="query_top_x")
def top_parts(spark: SparkSession, folder: str) -> DataFrame:
    return query_top_x(spark, _register(spark, folder, "part"), 10, "p_retailprice", "p_partkey")


@query("SELECT * FROM customer", name="read_named_table")
def named_customer(spark: SparkSession, folder: str) -> DataFrame:
    return read_named_table(spark, _register(spark, folder, "customer"))


@query(
    """
    SELECT CAST(year(o_orderdate) AS INT) AS y,
           CASE WHEN sum(CAST(o_totalprice AS DECIMAL(12,2))) > 570000000
                THEN 'greater' ELSE 'not greater' END AS label
    FROM orders GROUP BY 1
    """,
    name="threshold_label",
)
def yearly_label(spark: SparkSession, folder: str) -> DataFrame:
    total = F.sum(money("o_totalprice"))
    return (
        read_table(spark, folder, "orders")
        .groupBy(F.year("o_orderdate").alias("y"))
        .agg(threshold_label(total, 570000000, "greater", "not greater").alias("label"))
    )


@query(
    """
    SELECT p_partkey,
           CASE WHEN p_size % 5 = 0 THEN NULL ELSE round(100.0 / (p_size % 5), 4) END AS r,
           CASE WHEN p_size % 5 = 0 THEN 'divide by zero' END AS error_message
    FROM part
    """
)
def safe_divide(spark: SparkSession, folder: str) -> DataFrame:
    a, b = F.lit(100.0), F.col("p_size") % 5
    return read_table(spark, folder, "part").select(
        "p_partkey",
        F.round(quotient(a, b), 4).alias("r"),
        quotient_error(a, b).alias("error_message"),
    )
