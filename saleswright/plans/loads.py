"""All five tables loaded in one checked run, from files with faults in them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.plans.registry import query
from saleswright.session import scratch_path
from saleswright.sources.loading import Files, load_tables
from saleswright.sources.tables import read_table

# The files hold text; some of it is made not to fit, by an attribute of the row.
_FILES = {
    "Customer": (
        "customer",
        {
            "Id": "c_custkey",
            "FirstName": "c_name",
            "LastName": "if(c_nationkey = 15, NULL, c_mktsegment)",
            "City": "if(c_nationkey = 16, repeat('x', 41), c_mktsegment)",
        },
    ),
    "Supplier": (
        "supplier",
        {"Id": "if(s_nationkey = 15, 'none', CAST(s_suppkey AS STRING))", "CompanyName": "s_name"},
    ),
    "Product": (
        "part",
        {
            "Id": "p_partkey",
            "ProductName": "p_name",
            "SupplierId": "p_size",
            "UnitPrice": "if(p_size > 45, 'on request', CAST(p_retailprice AS STRING))",
        },
    ),
    "Order": (
        "orders",
        {
            "Id": "o_orderkey",
            "OrderDate": "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')",
            "CustomerId": "o_custkey",
            "TotalAmount": "CAST(o_totalprice AS DECIMAL(12,2))",
        },
    ),
    "OrderItem": (
        "lineitem",
        {
            "Id": "l_orderkey * 10 + l_linenumber",
            "OrderId": "l_orderkey",
            "ProductId": "l_partkey",
            "UnitPrice": "CAST(l_extendedprice AS DECIMAL(12,2))",
            "Quantity": "CAST(l_quantity AS INT)",
        },
    ),
}


@query(
    """
    WITH c AS (
        SELECT c_custkey AS k, CASE WHEN c_nationkey = 15 THEN 'LastName is null'
               WHEN c_nationkey = 16 THEN 'City over 40' END AS reason FROM customer
    ), s AS (
        SELECT s_suppkey AS k,
               CASE WHEN s_nationkey = 15 THEN 'Id cannot hold its text' END AS reason FROM supplier
    ), p AS (
        SELECT p_partkey AS k, CASE WHEN p_size > 45 THEN 'UnitPrice cannot hold its text'
               WHEN p_size NOT IN (SELECT k FROM s WHERE reason IS NULL)
               THEN 'FK_PRODUCT_REFERENCE_SUPPLIER' END AS reason FROM part
    ), o AS (
        SELECT o_orderkey AS k, CASE WHEN o_custkey NOT IN (SELECT k FROM c WHERE reason IS NULL)
               THEN 'FK_ORDER_REFERENCE_CUSTOMER' END AS reason FROM orders
    ), i AS (
        SELECT nullif(concat_ws('; ', CASE WHEN count(*) OVER (PARTITION BY l_orderkey * 10 + l_linenumber) > 1
                    THEN 'Id repeated' END,
               CASE WHEN l_orderkey NOT IN (SELECT k FROM o WHERE reason IS NULL)
                    THEN 'FK_ORDERITE_REFERENCE_ORDER' END,
               CASE WHEN l_partkey NOT IN (SELECT k FROM p WHERE reason IS NULL)
                    THEN 'FK_ORDERITE_REFERENCE_PRODUCT' END), '') AS reason
        FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 7)
    )
    SELECT 'Customer' AS table_name, reason, count(*) AS n FROM c GROUP BY reason
    UNION ALL SELECT 'Supplier', reason, count(*) FROM s GROUP BY reason
    UNION ALL SELECT 'Product', reason, count(*) FROM p GROUP BY reason
    UNION ALL SELECT 'Order', reason, count(*) FROM o GROUP BY reason
    UNION ALL SELECT 'OrderItem', reason, count(*) FROM i GROUP BY reason
    """
)
def load_five_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows loaded and rejected, by table and reason. Some names are NULL or too long, some keys and
    prices no numbers, the seventh lines come twice, and what refers to a rejected row is rejected."""
    base = scratch_path(spark, "five-tables")
    files = {}
    for name, (table, columns) in _FILES.items():
        rows = read_table(spark, folder, table)
        if name == "OrderItem":
            rows = rows.unionAll(rows.filter("l_linenumber = 7"))
        texts = [F.expr(text).cast("string").alias(column) for column, text in columns.items()]
        rows.select(*texts).write.csv(f"{base}/files/{name}")
        files[name] = Files(f"{base}/files/{name}", list(columns))
    return load_tables(spark, files, f"{base}/tables", "1")
