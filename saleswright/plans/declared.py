"""The library's own workload over the test tables, brought under the declared schemas.

Each query calls a method of ``Sales``, or a check of all tables, as a user of the library does.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.operators.quality import broken_references, fault_counts
from saleswright.plans.registry import query
from saleswright.plans.sales import Sales
from saleswright.sources.schemas import TABLES, complete_rows, require_schema
from saleswright.sources.tables import read_table

# The test tables have no city, phone or supplier key: other columns stand in for them.
_COLUMNS = {
    "Customer": (
        "customer",
        {
            "Id": "c_custkey",
            "FirstName": "c_name",
            "LastName": "c_mktsegment",
            "City": "c_mktsegment",
            "Country": "CAST(c_nationkey AS STRING)",
        },
    ),
    "Supplier": (
        "supplier",
        {
            "Id": "s_suppkey",
            "CompanyName": "s_name",
            "ContactName": "s_name",
            "Country": "CAST(s_nationkey AS STRING)",
            "Fax": "CAST(nullif(s_nationkey, 15) AS STRING)",
        },
    ),
    "Product": (
        "part",
        {
            "Id": "p_partkey",
            "ProductName": "p_name",
            "SupplierId": "p_size",
            "UnitPrice": "p_retailprice",
            "Package": "p_type",
            "IsDiscontinued": "p_size > 40",
        },
    ),
    "Order": (
        "orders",
        {
            "Id": "o_orderkey",
            "OrderDate": "o_orderdate",
            "OrderNumber": "CAST(o_orderkey AS STRING)",
            "CustomerId": "o_custkey",
            "TotalAmount": "o_totalprice",
        },
    ),
    "OrderItem": (
        "lineitem",
        {
            "Id": "l_orderkey * 10 + l_linenumber",
            "OrderId": "l_orderkey",
            "ProductId": "l_partkey",
            "UnitPrice": "l_extendedprice",
            "Quantity": "l_quantity",
        },
    ),
}


def declared_tables(spark: SparkSession, folder: str) -> Sales:
    """The five tables under their declared columns and types."""
    found = []
    for name, (table, columns) in _COLUMNS.items():
        given = read_table(spark, folder, table).select(
            *[F.expr(text).alias(column) for column, text in columns.items()]
        )
        schema = TABLES[name].schema
        found.append(require_schema(complete_rows(given, schema), schema))
    return Sales(*found)


def _as_sql() -> str:
    kinds = {"bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}
    parts = []
    for name, (table, columns) in _COLUMNS.items():
        selected = []
        for f in TABLES[name].schema.fields:
            kind = f.dataType.simpleString()
            kind = kinds.get(kind, "TIMESTAMP" if "timestamp" in kind else kind)
            text = columns.get(f.name, "NULL").replace("STRING", "VARCHAR")
            selected.append(f"CAST({text} AS {kind}) AS {f.name}")
        parts.append(f"the_{name} AS (SELECT {', '.join(selected)} FROM {table})")
    return f"WITH {', '.join(parts)} "


_WITH = _as_sql()


def declared_sql(text: str) -> str:
    """SQL over the tables under the declared schemas, each named ``the_`` and its name."""
    return _WITH + text


_PLACE = "FirstName, LastName, City, Country"
_MET = "the_Order o JOIN the_Customer c ON CustomerId = c.Id"
_OPEN = "the_Customer c LEFT JOIN the_Order o ON CustomerId = c.Id"
_DAY = f"""
    SELECT CAST(year(OrderDate) AS INTEGER) AS y, CAST(month(OrderDate) AS INTEGER) AS m,
           CAST(day(OrderDate) AS INTEGER) AS d, p.Id AS product_id, ProductName AS product_name,
           CAST(Quantity * i.UnitPrice AS DECIMAL(18,2)) AS sales, FirstName, LastName
    FROM the_OrderItem i JOIN the_Order o ON OrderId = o.Id JOIN the_Product p ON ProductId = p.Id
         JOIN the_Customer c ON CustomerId = c.Id
"""
_VALUE = "CAST(Quantity * CAST(UnitPrice AS DECIMAL(10,2)) * 0.9 AS DECIMAL(10,2))"
_YEAR = """
    SELECT CAST(trunc(sum(UnitPrice * Quantity)) AS BIGINT)
    FROM the_OrderItem i JOIN the_Order o ON OrderId = o.Id WHERE year(OrderDate) = 1998
"""

_QUERIES: dict[str, tuple[Callable[[Sales], DataFrame], str]] = {
    "row_counts": (
        Sales.row_counts,
        " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM the_{n}" for n in TABLES),
    ),
    "customer_names": (Sales.customer_names, "SELECT FirstName, LastName, City FROM the_Customer"),
    "customers_in": (
        lambda s: s.customers_in("3", "7"),
        "SELECT * FROM the_Customer WHERE Country IN ('3', '7')",
    ),
    "customers_not_in": (
        lambda s: s.customers_not_in("3"),
        "SELECT * FROM the_Customer WHERE Country <> '3'",
    ),
    "customers_by_place": (Sales.customers_by_place, f"SELECT Id, {_PLACE} FROM the_Customer"),
    "customers_of_city": (
        lambda s: s.customers_of_city("BUILDING"),
        "SELECT * FROM the_Customer WHERE City = 'BUILDING'",
    ),
    "suppliers_by_name": (
        Sales.suppliers_by_name,
        "SELECT Id, CompanyName, ContactName, City, Country FROM the_Supplier",
    ),
    "suppliers_in": (
        lambda s: s.suppliers_in("1", "2", "3", "4", "5"),
        "SELECT Id, CompanyName, City, Country FROM the_Supplier"
        " WHERE Country IN ('1', '2', '3', '4', '5')",
    ),
    "suppliers_with_fax": (
        Sales.suppliers_with_fax,
        "SELECT Id, CompanyName, Phone, Fax FROM the_Supplier WHERE Fax IS NOT NULL",
    ),
    "supplier_countries": (
        Sales.supplier_countries,
        "SELECT DISTINCT Country FROM the_Supplier",
    ),
    "supplier_count": (
        Sales.supplier_count,
        "SELECT count(*) AS n, 'The number of suppliers is ' || count(*) AS message"
        " FROM the_Supplier",
    ),
    "contacts": (
        Sales.contacts,
        "SELECT 'Customer' AS Type, FirstName || ' ' || LastName AS ContactName, City, Country,"
        " Phone FROM the_Customer UNION SELECT 'Supplier', ContactName, City, Country, Phone"
        " FROM the_Supplier",
    ),
    "dearest_products": (
        Sales.dearest_products,
        "SELECT Id, ProductName, UnitPrice, Package FROM the_Product"
        " ORDER BY UnitPrice DESC, Id LIMIT 10",
    ),
    "lowest_price": (Sales.lowest_price, "SELECT min(UnitPrice) AS lowest FROM the_Product"),
    "products_not_at": (
        lambda s: s.products_not_at(900, 901),
        "SELECT Id, ProductName, UnitPrice FROM the_Product WHERE UnitPrice NOT IN (900, 901)",
    ),
    "products_between": (
        lambda s: s.products_between(910, 920),
        "SELECT Id, ProductName, UnitPrice FROM the_Product WHERE UnitPrice BETWEEN 910 AND 920",
    ),
    "products_not_between": (
        lambda s: s.products_not_between(910, 920),
        "SELECT Id, ProductName, UnitPrice FROM the_Product"
        " WHERE UnitPrice NOT BETWEEN 910 AND 920",
    ),
    "products_like": (
        lambda s: s.products_like("red%", "% bol_"),
        "SELECT Id, ProductName, UnitPrice, Package FROM the_Product"
        " WHERE ProductName LIKE 'red%' OR ProductName LIKE '% bol_'",
    ),
    "active_products": (
        Sales.active_products,
        "SELECT ProductName AS productname, Id AS id, CAST(UnitPrice AS DECIMAL(11,2)) AS"
        " unit_price FROM the_Product WHERE NOT IsDiscontinued",
    ),
    "price_list": (
        Sales.price_list,
        "SELECT ProductName AS product_name, CAST(UnitPrice AS DECIMAL(10,2)) AS list_price"
        " FROM the_Product",
    ),
    "products_sold_over": (
        lambda s: s.products_sold_over(49),
        "SELECT ProductName FROM the_Product WHERE Id IN"
        " (SELECT ProductId FROM the_OrderItem WHERE Quantity > 49)",
    ),
    "suppliers_with_product_over": (
        lambda s: s.suppliers_with_product_over(990),
        "SELECT CompanyName FROM the_Supplier s WHERE EXISTS"
        " (SELECT 1 FROM the_Product WHERE SupplierId = s.Id AND UnitPrice > 990)",
    ),
    "orders_within": (
        lambda s: s.orders_within(1000, 50000),
        "SELECT Id, OrderDate, CustomerId, TotalAmount FROM the_Order"
        " WHERE TotalAmount >= 1000 AND TotalAmount <= 50000",
    ),
    "orders_outside": (
        lambda s: s.orders_outside(1000, 50000),
        "SELECT Id, OrderDate, CustomerId, TotalAmount FROM the_Order"
        " WHERE NOT (TotalAmount >= 1000 AND TotalAmount <= 50000)",
    ),
    "orders_of_year": (
        lambda s: s.orders_of_year(1997),
        "SELECT * FROM the_Order WHERE year(OrderDate) = 1997",
    ),
    "largest_order": (
        lambda s: s.largest_order(1997),
        "SELECT max(TotalAmount) AS largest FROM the_Order WHERE year(OrderDate) = 1997",
    ),
    "total_of_year": (
        lambda s: s.total_of_year(1997),
        "SELECT sum(TotalAmount) AS total FROM the_Order WHERE year(OrderDate) = 1997",
    ),
    "mean_order": (Sales.mean_order, "SELECT round(avg(TotalAmount), 4) AS media FROM the_Order"),
    "sold_between": (
        lambda s: s.sold_between(date(1996, 1, 1), date(1996, 6, 30), whole_last_day=True),
        "SELECT count(Id) AS n, sum(TotalAmount) AS total FROM the_Order"
        " WHERE OrderDate >= '1996-01-01' AND OrderDate < '1996-07-01'",
    ),
    "customers_per_country": (
        lambda s: s.customers_per_country("3", 2),
        "SELECT Country, count(Id) AS n FROM the_Customer WHERE Country <> '3'"
        " GROUP BY Country HAVING count(Id) >= 2",
    ),
    "orders_with_customer": (
        Sales.orders_with_customer,
        f"SELECT OrderNumber, TotalAmount, {_PLACE} FROM {_MET}",
    ),
    "total_per_customer": (
        Sales.total_per_customer,
        f"SELECT FirstName, LastName, sum(TotalAmount) AS total FROM {_MET} GROUP BY 1, 2",
    ),
    "total_per_customer_key": (
        Sales.total_per_customer_key,
        "SELECT c.Id AS customer_key, FirstName, LastName, sum(TotalAmount) AS total"
        f" FROM {_MET} GROUP BY 1, 2, 3",
    ),
    "customers_with_orders": (
        Sales.customers_with_orders,
        f"SELECT {_PLACE}, OrderNumber, TotalAmount FROM {_OPEN}",
    ),
    "customers_with_null_total": (
        Sales.customers_with_null_total,
        f"SELECT {_PLACE}, TotalAmount FROM {_OPEN} WHERE TotalAmount IS NULL",
    ),
    "customers_without_orders": (
        Sales.customers_without_orders,
        "SELECT * FROM the_Customer WHERE Id NOT IN (SELECT CustomerId FROM the_Order)",
    ),
    "order_counts": (
        Sales.order_counts,
        f"SELECT FirstName, LastName, count(o.Id) AS OrderCount FROM {_OPEN} GROUP BY c.Id, 1, 2",
    ),
    "customers_with_mean_between": (
        lambda s: s.customers_with_mean_between(100000, 200000),
        f"SELECT FirstName, LastName, round(avg(TotalAmount), 4) AS media FROM {_MET}"
        " GROUP BY 1, 2 HAVING avg(TotalAmount) BETWEEN 100000 AND 200000",
    ),
    "order_lines": (
        Sales.order_lines,
        "SELECT OrderNumber, OrderDate AS Datetime, ProductName, Quantity, i.UnitPrice"
        " FROM the_OrderItem i JOIN the_Order o ON OrderId = o.Id"
        " JOIN the_Product p ON ProductId = p.Id",
    ),
    "salesday_sorted": (
        Sales.salesday_sorted,
        f"SELECT y, m, d, product_id, product_name, sales FROM ({_DAY})",
    ),
    "salesday_with_customer": (Sales.salesday_with_customer, _DAY),
    "by_month": (
        Sales.sales_by_month,
        f"SELECT y, m, sum(sales) AS sales_month FROM ({_DAY}) GROUP BY y, m",
    ),
    "mean_by_year": (
        Sales.mean_sale_by_year,
        f"SELECT y, round(avg(sales), 4) AS sales_avg FROM ({_DAY}) GROUP BY y",
    ),
    "top_customers": (
        Sales.top_customers,
        f"SELECT FirstName || ' ' || LastName AS customer, sum(sales) AS total FROM ({_DAY})"
        " GROUP BY 1 ORDER BY total DESC, customer LIMIT 5",
    ),
    "discounted_lines": (
        Sales.discounted_lines,
        f"SELECT Id, sum({_VALUE}) AS final_sale_value FROM the_OrderItem GROUP BY Id",
    ),
    "year_against": (
        lambda s: s.year_against(1998, 1000),
        f"SELECT ({_YEAR}) AS totalsales, CASE WHEN ({_YEAR}) > 1000"
        " THEN '1998 sales are greater than 1000'"
        " ELSE '1998 sales are not greater than 1000' END AS message",
    ),
    "broken_references": (
        lambda s: broken_references(s.by_name(), list(TABLES.values())),
        " UNION ALL ".join(
            f"SELECT '{key.name}' AS constraint_name, Id AS row_key, {key.column} AS reference"
            f" FROM the_{spec.name} WHERE {key.column} NOT IN (SELECT Id FROM the_{key.parent})"
            for spec in TABLES.values()
            for key in spec.foreign_keys
        ),
    ),
}


def _registered(name: str, ask: Callable[[Sales], DataFrame], sql: str) -> None:
    @query(_WITH + sql, name=f"sales_{name}")
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return ask(declared_tables(spark, folder))


for _table in TABLES:
    _QUERIES[f"schema_{_table.lower()}"] = (
        lambda s, table=_table: s.by_name()[table],
        f"SELECT * FROM the_{_table}",
    )
for _name, (_ask, _sql) in _QUERIES.items():
    _registered(_name, _ask, _sql)


def _faulty(spec_name: str, spark: SparkSession, folder: str) -> DataFrame:
    """A table whose first text with a limit is too long or NULL, by the last digit of the key."""
    spec = TABLES[spec_name]
    table = declared_tables(spark, folder).by_name()[spec_name]
    text, limit = next(iter(spec.text_limits.items()))
    long = F.repeat(text, limit) if text != "OrderNumber" else F.concat(text, F.lit("0" * 11))
    changed = F.when(F.col("Id") % 10 == 0, long).when(F.col("Id") % 10 != 1, F.col(text))
    return table.withColumn(text, changed)


@query(
    _WITH
    + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, rule, n FROM (SELECT '{text} is null' AS rule,"
        f" count(*) AS n FROM the_{name} WHERE Id % 10 = 1 UNION ALL SELECT '{text} over {limit}',"
        f" count(*) FROM the_{name} WHERE Id % 10 = 0) WHERE n > 0"
        + (" AND rule NOT LIKE '%null'" if name == "Order" else "")
        for name, text, limit in (
            (spec.name, *next(iter(spec.text_limits.items())))
            for spec in TABLES.values()
            if spec.text_limits
        )
    ),
    name="sales_check_rules",
)
def check_rules(spark: SparkSession, folder: str) -> DataFrame:
    """The NOT NULL and length rules of all tables with texts; one text of each is made too long
    or NULL in some rows."""
    found = [
        fault_counts(_faulty(name, spark, folder), spec).select(
            F.lit(name).alias("table_name"), "rule", "n"
        )
        for name, spec in TABLES.items()
        if spec.text_limits
    ]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])
