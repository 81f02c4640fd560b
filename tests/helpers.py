"""Small rows in the shapes of the sales tables, and ways to look at results."""

from datetime import datetime
from decimal import Decimal

from saleswright.plans.sales import Sales
from saleswright.sources.schemas import CUSTOMER, ORDER, ORDER_ITEM, PRODUCT, SUPPLIER


def frame(spark, rows, schema):
    """Rows under a schema in which every column may be NULL, as files hold them."""
    from pyspark.sql.types import StructField, StructType

    loose = StructType([StructField(f.name, f.dataType) for f in schema.fields])
    return spark.createDataFrame(rows, loose)


def tuples(df):
    return [tuple(row) for row in df.collect()]


def as_set(df):
    rows = tuples(df)
    assert len(rows) == len(set(rows)), "unexpected duplicates"
    return set(rows)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


D = Decimal

CUSTOMERS = [
    (1, "Ana", "Sá", "São Paulo", "Brazil", "334-1"),
    (2, "Ana", "Sá", "Sao Paulo", "Brazil", "5"),
    (3, "Joe", "Low", None, None, None),
    (4, "Kim", "Roe", "London", "UK", "555"),
    (5, "Ulf", "Ek", "Lund", "Sweden", "7"),
]
SUPPLIERS = [
    (1, "Acme", "Al Bo", None, "Leeds", "UK", "1", None),
    (2, "Bolt", "Cy Day", None, "Lyon", "France", "2", "22"),
    (3, "acme", None, None, "Rome", "Italy", "3", None),
]
PRODUCTS = [
    (1, "Chai", 1, D("18.00"), "box", False),
    (2, "chai", 1, D("18.00"), "box", True),
    (3, "Chang", 2, D("120.00"), None, False),
    (4, "100%_pure", 2, None, "jar", False),
    (5, "Zu", 3, D("9.99"), "can", True),
]
ORDERS = [
    (1, datetime(2013, 1, 1), "900", 1, D("100.00")),
    (2, datetime(2013, 1, 31, 12), "901", 1, D("300.00")),
    (3, datetime(2013, 12, 31, 23, 59, 59), "902", 2, D("50.00")),
    (4, datetime(2014, 1, 1), "903", 4, None),
    (5, datetime(2014, 5, 5), "904", 4, D("70.00")),
]
ITEMS = [
    (1, 1, 1, D("10.00"), 10),
    (2, 2, 3, D("100.00"), 3),
    (3, 3, 1, D("0.05"), 1000),
    (4, 4, 3, D("1.11"), 1),
    (5, 5, 2, D("7.00"), 10),
]


def small_sales(spark):
    return Sales(
        frame(spark, CUSTOMERS, CUSTOMER.schema),
        frame(spark, SUPPLIERS, SUPPLIER.schema),
        frame(spark, PRODUCTS, PRODUCT.schema),
        frame(spark, ORDERS, ORDER.schema),
        frame(spark, ITEMS, ORDER_ITEM.schema),
    )
