"""Sources, copies, staging, filters and sorts over the test tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.functions.scalar import (
    between_stamps,
    in_year,
    money,
    money_sum,
    on_days,
    stamp_as_text,
    stamp_from_text,
)
from saleswright.operators.numbering import number_rows
from saleswright.plans.registry import query
from saleswright.plans.reports import ProductColumns, product_list_top
from saleswright.session import scratch_path
from saleswright.sources.schemas import ORDER, SUPPLIER, complete_rows, require_schema
from saleswright.sources.tables import (
    bulk_load,
    drop_staged_for_all,
    drop_table,
    empty_table,
    read_table,
    row_counts,
    select_into,
    select_into_table,
    stage_for_all,
    stage_for_session,
)

PART = ProductColumns("p_partkey", "p_name", "p_retailprice")


def _price() -> Column:
    return money("p_retailprice").alias("price")


def _total() -> Column:
    return money("o_totalprice").alias("total")


# --- sources, copies, staging ---------------------------------------------------------


@query("SELECT * FROM supplier")
def scan_all(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "supplier")


@query(
    """
    SELECT o_orderkey AS "Id", o_orderdate AS "OrderDate",
           CAST(o_orderkey AS VARCHAR) AS "OrderNumber", o_custkey AS "CustomerId",
           CAST(o_totalprice AS DECIMAL(12,2)) AS "TotalAmount"
    FROM orders
    """
)
def table_schemas(spark: SparkSession, folder: str) -> DataFrame:
    """The orders under the declared schema of Order, which the result must then meet."""
    orders = read_table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("Id"),
        F.col("o_orderdate").alias("OrderDate"),
        F.col("o_orderkey").alias("OrderNumber"),
        F.col("o_custkey").alias("CustomerId"),
        F.col("o_totalprice").alias("TotalAmount"),
    )
    return require_schema(complete_rows(orders, ORDER.schema), ORDER.schema)


@query(
    """
    SELECT s_suppkey AS "Id", s_name AS "CompanyName",
           CAST(NULL AS VARCHAR) AS "ContactName", CAST(NULL AS VARCHAR) AS "ContactTitle",
           CAST(NULL AS VARCHAR) AS "City", CAST(s_nationkey AS VARCHAR) AS "Country",
           CAST(NULL AS VARCHAR) AS "Phone", CAST(NULL AS VARCHAR) AS "Fax"
    FROM supplier
    """
)
def bulk_load_keep_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as files with three of the eight columns, loaded with their own keys."""
    files = scratch_path(spark, "supplier-files")
    read_table(spark, folder, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey"
    ).write.csv(files)
    target = scratch_path(spark, "supplier")
    return bulk_load(spark, files, SUPPLIER, target, "1", ["Id", "CompanyName", "Country"])


@query(
    """
    SELECT o_orderkey, strptime(strftime(o_orderdate, '%b %d %Y'), '%b %d %Y') AS ts
    FROM orders
    """
)
def parse_order_date(spark: SparkSession, folder: str) -> DataFrame:
    text = stamp_as_text("o_orderdate")
    return read_table(spark, folder, "orders").select(
        "o_orderkey", stamp_from_text(text).alias("ts")
    )


@query(
    """
    SELECT 'customer' AS table_name, count(*) AS n FROM customer
    UNION ALL SELECT 'supplier', count(*) FROM supplier
    UNION ALL SELECT 'part', count(*) FROM part
    UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    """
)
def table_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    names = ("customer", "supplier", "part", "orders", "lineitem")
    return row_counts({name: read_table(spark, folder, name) for name in names})


@query("SELECT * FROM supplier WHERE s_nationkey = 15", name="select_into")
def suppliers_of_nation(spark: SparkSession, folder: str) -> DataFrame:
    """Write a table, read it back and drop it; its files stay for the result to read."""
    chosen = read_table(spark, folder, "supplier").filter("s_nationkey = 15")
    path = scratch_path(spark, "supplier-copy")
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    select_into_table(chosen, table, path)
    drop_table(spark, table)
    return spark.read.schema(chosen.schema).parquet(path)


@query("SELECT * FROM lineitem")
def snapshot_copy(spark: SparkSession, folder: str) -> DataFrame:
    return select_into(read_table(spark, folder, "lineitem"), scratch_path(spark, "lineitem"))


@query("SELECT * FROM lineitem WHERE 1 = 0")
def truncate_table(spark: SparkSession, folder: str) -> DataFrame:
    return empty_table(read_table(spark, folder, "lineitem"), scratch_path(spark, "lineitem"))


@query(
    """
    SELECT p_name, p_partkey, CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price
    FROM part WHERE p_size <= 40
    """
)
def stage_active_products(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read_table(spark, folder, "part")
        .filter("p_size <= 40")
        .select("p_name", "p_partkey", money("p_retailprice").alias("unit_price"))
    )


PRICE_LIST_SQL = """
    SELECT p_name AS product_name, CAST(p_retailprice AS DECIMAL(10,2)) AS list_price FROM part
"""


def _price_list(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "part").select(
        F.col("p_name").alias("product_name"), money("p_retailprice", 10).alias("list_price")
    )


@query(PRICE_LIST_SQL)
def stage_session_table(spark: SparkSession, folder: str) -> DataFrame:
    return stage_for_session(_price_list(spark, folder), "temp_products_local")


@query(PRICE_LIST_SQL)
def stage_global_table(spark: SparkSession, folder: str) -> DataFrame:
    staged = stage_for_all(_price_list(spark, folder), "temp_products_global")
    drop_staged_for_all(spark, "temp_products_global")
    return staged


# --- projections and filters ----------------------------------------------------------


@query("SELECT c_name, c_mktsegment FROM customer")
def project_columns(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "customer").select("c_name", "c_mktsegment")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_eq(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, folder, "customer")
    return customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3")
def filter_and(spark: SparkSession, folder: str) -> DataFrame:
    both = (F.col("c_mktsegment") == "BUILDING") & (F.col("c_nationkey") == 3)
    return read_table(spark, folder, "customer").filter(both).select("c_custkey", "c_name")


@query("SELECT c_custkey FROM customer WHERE c_nationkey = 3 OR c_nationkey = 7")
def filter_or(spark: SparkSession, folder: str) -> DataFrame:
    either = (F.col("c_nationkey") == 3) | (F.col("c_nationkey") == 7)
    return read_table(spark, folder, "customer").filter(either).select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE NOT c_mktsegment = 'BUILDING'")
def filter_not(spark: SparkSession, folder: str) -> DataFrame:
    other = ~(F.col("c_mktsegment") == "BUILDING")
    return read_table(spark, folder, "customer").filter(other).select("c_custkey")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey IN (1, 2, 3)")
def filter_in(spark: SparkSession, folder: str) -> DataFrame:
    supplier = read_table(spark, folder, "supplier")
    return supplier.filter(F.col("s_nationkey").isin(1, 2, 3)).select("s_suppkey", "s_name")


@query(
    """
    SELECT p_partkey, CAST(p_retailprice AS DECIMAL(12,2)) AS price FROM part
    WHERE CAST(p_retailprice AS DECIMAL(12,2)) NOT IN (900, 910, 920)
    """
)
def filter_not_in(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part").select("p_partkey", _price())
    return part.filter(~F.col("price").isin(900, 910, 920))


@query(
    """
    SELECT o_orderkey, o_orderdate, o_custkey, CAST(o_totalprice AS DECIMAL(12,2)) AS total
    FROM orders WHERE o_totalprice >= 100000 AND o_totalprice <= 150000
    """
)
def filter_range_sorted(spark: SparkSession, folder: str) -> DataFrame:
    in_range = (F.col("o_totalprice") >= 100000) & (F.col("o_totalprice") <= 150000)
    return (
        read_table(spark, folder, "orders")
        .filter(in_range)
        .select("o_orderkey", "o_orderdate", "o_custkey", _total())
        .orderBy(F.desc("total"), "o_orderkey")
    )


@query(
    """
    SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS total
    FROM orders WHERE NOT (o_totalprice >= 100000 AND o_totalprice <= 450000)
    """
)
def filter_not_range_sorted(spark: SparkSession, folder: str) -> DataFrame:
    in_range = (F.col("o_totalprice") >= 100000) & (F.col("o_totalprice") <= 450000)
    return (
        read_table(spark, folder, "orders")
        .filter(~in_range)
        .select("o_orderkey", _total())
        .orderBy(F.desc("total"), "o_orderkey")
    )


@query(
    """
    SELECT p_partkey, CAST(p_retailprice AS DECIMAL(12,2)) AS price FROM part
    WHERE p_retailprice BETWEEN 911 AND 922
    """
)
def filter_between(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read_table(spark, folder, "part")
        .filter(F.col("p_retailprice").between(911, 922))
        .select("p_partkey", _price())
        .orderBy("price", "p_partkey")
    )


@query(
    """
    SELECT p_partkey, CAST(p_retailprice AS DECIMAL(12,2)) AS price FROM part
    WHERE p_retailprice NOT BETWEEN 905 AND 990
    """
)
def filter_not_between(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read_table(spark, folder, "part")
        .filter(~F.col("p_retailprice").between(905, 990))
        .select("p_partkey", _price())
        .orderBy("price", "p_partkey")
    )


@query(
    """
    SELECT count(o_orderkey) AS n, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total FROM orders
    WHERE o_orderdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-01-31'
    """
)
def filter_date_between(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    days = between_stamps(orders, "o_orderdate", date(1998, 1, 1), date(1998, 1, 31))
    return orders.filter(days).agg(
        F.count("o_orderkey").alias("n"), money_sum(_total()).alias("total")
    )


@query(
    """
    SELECT count(o_orderkey) AS n, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS total FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-02-01'
    """
)
def filter_date_whole_days(spark: SparkSession, folder: str) -> DataFrame:
    """What the query above is meant to count: the whole month, with its last day."""
    orders = read_table(spark, folder, "orders")
    days = on_days(orders, "o_orderdate", date(1998, 1, 1), date(1998, 1, 31))
    return orders.filter(days).agg(
        F.count("o_orderkey").alias("n"), money_sum(_total()).alias("total")
    )


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 're%'")
def filter_like_prefix(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part")
    return part.filter(F.col("p_name").like("re%")).select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red rin_' OR p_name LIKE 'red bol_'")
def filter_like_single_char(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("p_name")
    either = name.like("red rin_") | name.like("red bol_")
    return read_table(spark, folder, "part").filter(either).select("p_partkey", "p_name")


@query("SELECT s_suppkey, s_name FROM supplier WHERE s_name LIKE '%03%'")
def filter_like_contains(spark: SparkSession, folder: str) -> DataFrame:
    supplier = read_table(spark, folder, "supplier")
    return supplier.filter(F.col("s_name").like("%03%")).select("s_suppkey", "s_name")


def _supplier_nations(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers with a nation that is NULL for some, as the test tables hold no NULL."""
    nation = F.nullif("s_nationkey", F.lit(15)).alias("nk")
    return read_table(spark, folder, "supplier").select("s_suppkey", nation)


@query(
    "SELECT s_suppkey, nullif(s_nationkey, 15) AS nk FROM supplier"
    " WHERE nullif(s_nationkey, 15) IS NULL"
)
def filter_is_null(spark: SparkSession, folder: str) -> DataFrame:
    return _supplier_nations(spark, folder).filter(F.col("nk").isNull())


@query(
    "SELECT s_suppkey, nullif(s_nationkey, 15) AS nk FROM supplier"
    " WHERE nullif(s_nationkey, 15) IS NOT NULL"
)
def filter_is_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return _supplier_nations(spark, folder).filter(F.col("nk").isNotNull())


@query(
    "SELECT p_name, CAST(p_retailprice AS DECIMAL(12,2)) AS list_price"
    " FROM part WHERE p_partkey = 1"
)
def filter_point_lookup(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part").filter(F.col("p_partkey") == 1)
    return part.select("p_name", money("p_retailprice").alias("list_price"))


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE CAST(year(o_orderdate) AS INT) = 1998")
def filter_year_param(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    return orders.filter(in_year(orders, "o_orderdate", 1998)).select("o_orderkey", "o_orderdate")


# --- sorts, limits, distinct ----------------------------------------------------------


@query("SELECT s_suppkey, row_number() OVER (ORDER BY s_name, s_suppkey) AS rn FROM supplier")
def sort_asc(spark: SparkSession, folder: str) -> DataFrame:
    supplier = read_table(spark, folder, "supplier").select("s_suppkey", "s_name")
    return number_rows(supplier, [F.asc("s_name"), F.asc("s_suppkey")]).drop("s_name")


@query("SELECT s_suppkey, row_number() OVER (ORDER BY s_name DESC, s_suppkey) AS rn FROM supplier")
def sort_desc(spark: SparkSession, folder: str) -> DataFrame:
    supplier = read_table(spark, folder, "supplier").select("s_suppkey", "s_name")
    return number_rows(supplier, [F.desc("s_name"), F.asc("s_suppkey")]).drop("s_name")


@query(
    """
    SELECT c_custkey, row_number() OVER (ORDER BY c_nationkey, c_mktsegment, c_custkey) AS rn
    FROM customer
    """
)
def sort_multi(spark: SparkSession, folder: str) -> DataFrame:
    keys = ["c_nationkey", "c_mktsegment", "c_custkey"]
    customer = read_table(spark, folder, "customer").select(*keys)
    return number_rows(customer, [F.asc(key) for key in keys]).select("c_custkey", "rn")


@query(
    """
    SELECT p_partkey, p_name, CAST(p_retailprice AS DECIMAL(12,2)) AS price
    FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10
    """
)
def top_n(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read_table(spark, folder, "part")
        .orderBy(F.desc("p_retailprice"), "p_partkey")
        .limit(10)
        .select("p_partkey", "p_name", _price())
    )


@query("SELECT p_partkey, p_name FROM part ORDER BY p_name DESC, p_partkey LIMIT 1000")
def top_n_list(spark: SparkSession, folder: str) -> DataFrame:
    part = read_table(spark, folder, "part").select("p_partkey", "p_name")
    return product_list_top(part, 1000, PART, descending=True)


@query()
def top_unsorted(spark: SparkSession, folder: str) -> DataFrame:
    """Any 1000 orders of a year; which ones is left open, so there is no SQL to compare."""
    return filter_year_param(spark, folder).limit(1000)


@query("SELECT DISTINCT s_nationkey FROM supplier")
def distinct_sorted(spark: SparkSession, folder: str) -> DataFrame:
    supplier = read_table(spark, folder, "supplier")
    return supplier.select("s_nationkey").distinct().orderBy("s_nationkey")
