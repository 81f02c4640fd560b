"""Column expressions on the edges of their ranges."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import D, as_set, frame, plan, small_sales, tuples
from saleswright.functions.scalar import (
    between_stamps,
    contains_text,
    discounted,
    in_year,
    joined_text,
    on_days,
    whole_quotient,
)
from saleswright.functions.table_functions import (
    products_by_status,
    register_discount,
    register_products_by_status,
)
from saleswright.sources.schemas import ORDER


@pytest.fixture
def stamps(spark):
    moments = [
        datetime(2012, 12, 31, 23, 59, 59, 999999),
        datetime(2013, 1, 1),
        datetime(2013, 1, 31),
        datetime(2013, 1, 31, 12),
        datetime(2013, 12, 31, 23, 59, 59, 999999),
        datetime(2014, 1, 1),
        None,
    ]
    rows = [(i, moment, None, 1, None) for i, moment in enumerate(moments)]
    return frame(spark, rows, ORDER.schema)


def ids(df):
    return sorted(row.Id for row in df.collect())


def test_in_year_equals_the_year_function(stamps):
    assert ids(stamps.filter(in_year(stamps, "OrderDate", 2013))) == [1, 2, 3, 4]
    assert ids(stamps.filter(F.year("OrderDate") == 2013)) == [1, 2, 3, 4]


def test_in_year_on_zoned_stamps_and_dates(stamps):
    for kind in ("timestamp", "date"):
        typed = stamps.withColumn("OrderDate", F.col("OrderDate").cast(kind))
        assert ids(typed.filter(in_year(typed, "OrderDate", 2013))) == [1, 2, 3, 4]


def test_between_ends_at_midnight_and_on_days_ends_with_the_day(stamps):
    first, last = date(2013, 1, 1), date(2013, 1, 31)
    assert ids(stamps.filter(between_stamps(stamps, "OrderDate", first, last))) == [1, 2]
    assert ids(stamps.filter(on_days(stamps, "OrderDate", first, last))) == [1, 2, 3]


def test_text_search_and_case(spark):
    names = spark.createDataFrame(
        [("Singaporean Hokkien",), ("HOK",), ("São",), ("Sao",), ("100%_x",), ("a\\b",), (None,)],
        "name string",
    )

    def found(text, ignore_case):
        return as_set(names.filter(contains_text("name", text, ignore_case)))

    assert found("hok", False) == set()
    assert found("hok", True) == {("Singaporean Hokkien",), ("HOK",)}
    assert found("sao", True) == {("Sao",)}
    assert found("SÃO", True) == {("São",)}
    assert found("H_K", False) == {("HOK",)}
    assert found("\\", False) == {("a\\b",)}
    assert found("", False) == {(n,) for (n,) in tuples(names) if n is not None}


def test_joined_text_is_null_if_a_part_is(spark):
    df = spark.sql("SELECT 'a' AS x, CAST(NULL AS STRING) AS y")
    assert tuples(df.select(joined_text("x", "x"), joined_text("x", "y"))) == [("a a", None)]


@pytest.mark.parametrize(
    "quantity, price, rate, value",
    [
        (10, "100", "0.1", "900.00"),
        (1, "0.05", "0.1", "0.05"),  # 0.045 rounds up
        (3, "0.05", "0.10", "0.14"),  # 0.135 rounds up
        (-1, "0.05", "0.1", "-0.05"),
        (None, "1", "0.1", None),
    ],
)
def test_discount(spark, quantity, price, rate, value):
    df = spark.range(1).select(
        discounted(F.lit(quantity), F.lit(price), F.lit(rate)).alias("v")
    )
    register_discount(spark)
    sql = spark.sql(
        "SELECT FuncDiscount(:q, :p, :r)", args={"q": quantity, "p": D(price), "r": D(rate)}
    )
    expected = None if value is None else Decimal(value)
    assert df.collect()[0][0] == expected
    assert sql.collect()[0][0] == expected
    assert "Python" not in plan(sql)


def test_whole_quotient_drops_the_fraction(spark):
    df = spark.range(1).select(
        whole_quotient(F.lit(10), F.lit(4)), whole_quotient(F.lit(-7), F.lit(2))
    )
    assert tuples(df) == [(2, -3)]


def test_products_by_status(spark):
    product = small_sales(spark).product
    assert as_set(products_by_status(product, True)) == {(2, "chai"), (5, "Zu")}
    assert as_set(products_by_status(product, False)) == {
        (1, "Chai"), (3, "Chang"), (4, "100%_pure")
    }


def test_products_by_status_in_sql(spark):
    small_sales(spark).product.createOrReplaceTempView("product_for_function")
    register_products_by_status(spark, "product_for_function")
    discontinued = spark.sql("SELECT * FROM fn_get_products_by_status(true)")
    assert as_set(discontinued) == {(2, "chai"), (5, "Zu")}
    assert spark.sql("SELECT * FROM fn_get_products_by_status(false)").count() == 3
