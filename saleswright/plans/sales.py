"""The query workload on the five sales tables: one method per question.

``Sales`` holds the tables under the columns that ``sources.schemas`` declares. Sorted results
end in the key, which orders ties. Text is compared by case unless ``ignore_case`` is given.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswright.functions.scalar import (
    between_stamps,
    discounted,
    in_year,
    joined_text,
    mean,
    money_sum,
    on_days,
)
from saleswright.operators.aggregates import (
    count_per_parent,
    joined_in_parts,
    mean_per_name_between,
    threshold_label,
    total_per_name,
)
from saleswright.operators.joins import (
    inner,
    outer_one_to_many,
    outer_where_null,
    with_match,
    without_match,
)
from saleswright.plans import views
from saleswright.sources.schemas import TABLES
from saleswright.sources.tables import read_declared, row_counts

PLACE = ("FirstName", "LastName", "City", "Country")


@dataclass(frozen=True)
class Sales:
    customer: DataFrame
    supplier: DataFrame
    product: DataFrame
    order: DataFrame
    order_item: DataFrame

    @staticmethod
    def read(spark: SparkSession, folder: str) -> Sales:
        """The tables as Parquet under ``folder``, one per table name."""
        return Sales(
            *[read_declared(spark, f"{folder}/{name}", spec) for name, spec in TABLES.items()]
        )

    def by_name(self) -> dict[str, DataFrame]:
        return {
            "Customer": self.customer,
            "Supplier": self.supplier,
            "Product": self.product,
            "Order": self.order,
            "OrderItem": self.order_item,
        }

    def register(self) -> None:
        """Name the tables and the sales view for SQL of this session."""
        for name, df in self.by_name().items():
            df.createOrReplaceTempView(name)
        self.salesday_with_customer().createOrReplaceTempView("salesday")

    def row_counts(self) -> DataFrame:
        return row_counts(self.by_name())

    # --- customers and suppliers ------------------------------------------------------

    def customer_names(self) -> DataFrame:
        return self.customer.select("FirstName", "LastName", "City")

    def customers_in(self, *countries: str) -> DataFrame:
        return self.customer.filter(F.col("Country").isin(*countries))

    def customers_not_in(self, country: str) -> DataFrame:
        """Customers of other countries; without a country it is not known, so not listed."""
        return self.customer.filter(F.col("Country") != country)

    def customers_called(self, first: str, last: str) -> DataFrame:
        return self.customer.filter((F.col("FirstName") == first) & (F.col("LastName") == last))

    def customers_by_place(self) -> DataFrame:
        return self.customer.select("Id", *PLACE).orderBy("Country", "City", "Id")

    def customers_of_city(self, city: str) -> DataFrame:
        """The view of one city's customers; see also ``changes.insert_through_view``."""
        return self.customer.filter(F.col("City") == city)

    def suppliers_by_name(self, descending: bool = False) -> DataFrame:
        name = F.desc("CompanyName") if descending else F.asc("CompanyName")
        return self.supplier.select(
            "Id", "CompanyName", "ContactName", "City", "Country"
        ).orderBy(name, "Id")

    def suppliers_in(self, *countries: str) -> DataFrame:
        return self.supplier.filter(F.col("Country").isin(*countries)).select(
            "Id", "CompanyName", "City", "Country"
        )

    def suppliers_with_fax(self, known: bool = True) -> DataFrame:
        has_fax = F.col("Fax").isNotNull() if known else F.col("Fax").isNull()
        return self.supplier.filter(has_fax).select("Id", "CompanyName", "Phone", "Fax")

    def supplier_countries(self) -> DataFrame:
        return self.supplier.select("Country").distinct().orderBy("Country")

    def supplier_count(self) -> DataFrame:
        message = F.concat(F.lit("The number of suppliers is "), F.col("n").cast("string"))
        return self.supplier.agg(F.count("*").alias("n")).withColumn("message", message)

    def contacts(self) -> DataFrame:
        """All customers and supplier contacts, each once."""
        customers = self.customer.select(
            F.lit("Customer").alias("Type"),
            joined_text("FirstName", "LastName").alias("ContactName"),
            "City",
            "Country",
            "Phone",
        )
        suppliers = self.supplier.select(
            F.lit("Supplier"), "ContactName", "City", "Country", "Phone"
        )
        return customers.union(suppliers).distinct()

    # --- products ---------------------------------------------------------------------

    def dearest_products(self, n: int = 10) -> DataFrame:
        return (
            self.product.select("Id", "ProductName", "UnitPrice", "Package")
            .orderBy(F.desc("UnitPrice"), "Id")
            .limit(n)
        )

    def lowest_price(self) -> DataFrame:
        return self.product.agg(F.min("UnitPrice").alias("lowest"))

    def _prices(self, chosen: Column) -> DataFrame:
        return self.product.filter(chosen).select("Id", "ProductName", "UnitPrice")

    def products_not_at(self, *prices: int | Decimal) -> DataFrame:
        return self._prices(~F.col("UnitPrice").isin(*prices))

    def products_between(self, low: int | Decimal, high: int | Decimal) -> DataFrame:
        return self._prices(F.col("UnitPrice").between(low, high)).orderBy("UnitPrice", "Id")

    def products_not_between(self, low: int | Decimal, high: int | Decimal) -> DataFrame:
        return self._prices(~F.col("UnitPrice").between(low, high)).orderBy("UnitPrice", "Id")

    def products_like(self, *patterns: str) -> DataFrame:
        """Products whose name fits a LIKE pattern; a backslash makes ``%`` and ``_`` plain."""
        fits = F.lit(False)
        for pattern in patterns:
            fits = fits | F.col("ProductName").like(pattern)
        return self.product.filter(fits).select("Id", "ProductName", "UnitPrice", "Package")

    def all_product_names(self, keys_per_part: int = 10000) -> DataFrame:
        """All names joined by line feeds, as parts that each cover a range of keys."""
        return joined_in_parts(
            self.product, [], "ProductName", "Id", keys_per_part, "AllProductNames"
        ).orderBy("part_no")

    def active_products(self) -> DataFrame:
        return self.product.filter(~F.col("IsDiscontinued")).select(
            F.col("ProductName").alias("productname"),
            F.col("Id").alias("id"),
            F.col("UnitPrice").cast("decimal(11,2)").alias("unit_price"),
        )

    def price_list(self) -> DataFrame:
        return self.product.select(
            F.col("ProductName").alias("product_name"),
            F.col("UnitPrice").cast("decimal(10,2)").alias("list_price"),
        )

    def products_sold_over(self, quantity: int) -> DataFrame:
        large = self.order_item.filter(F.col("Quantity") > quantity)
        return with_match(self.product, large, [("Id", "ProductId")]).select("ProductName")

    def suppliers_with_product_over(self, price: int | Decimal) -> DataFrame:
        dear = self.product.filter(F.col("UnitPrice") > price)
        return with_match(self.supplier, dear, [("Id", "SupplierId")]).select("CompanyName")

    # --- orders -----------------------------------------------------------------------

    def _order_list(self, chosen: Column) -> DataFrame:
        return (
            self.order.filter(chosen)
            .select("Id", "OrderDate", "CustomerId", "TotalAmount")
            .orderBy(F.desc("TotalAmount"), "Id")
        )

    def orders_within(self, low: int | Decimal, high: int | Decimal) -> DataFrame:
        return self._order_list((F.col("TotalAmount") >= low) & (F.col("TotalAmount") <= high))

    def orders_outside(self, low: int | Decimal, high: int | Decimal) -> DataFrame:
        return self._order_list(~((F.col("TotalAmount") >= low) & (F.col("TotalAmount") <= high)))

    def orders_of_year(self, year: int, n: int | None = None) -> DataFrame:
        """Orders of a year, or any ``n`` of them."""
        chosen = self.order.filter(in_year(self.order, "OrderDate", year))
        return chosen if n is None else chosen.limit(n)

    def largest_order(self, year: int) -> DataFrame:
        return self.orders_of_year(year).agg(F.max("TotalAmount").alias("largest"))

    def total_of_year(self, year: int) -> DataFrame:
        return self.orders_of_year(year).agg(money_sum("TotalAmount").alias("total"))

    def mean_order(self) -> DataFrame:
        return self.order.agg(mean(F.sum("TotalAmount"), F.count("TotalAmount")).alias("media"))

    def sold_between(self, first: date, last: date, whole_last_day: bool = False) -> DataFrame:
        """Number and total of orders. The last day counts up to its midnight, or as a whole."""
        days = on_days if whole_last_day else between_stamps
        return self.order.filter(days(self.order, "OrderDate", first, last)).agg(
            F.count("Id").alias("n"), money_sum("TotalAmount").alias("total")
        )

    # --- customers and their orders ---------------------------------------------------

    def _customer_names_by_key(self) -> DataFrame:
        return self.customer.select(F.col("Id").alias("customer_key"), *PLACE)

    def customers_per_country(
        self, other_than: str | None = None, at_least: int = 0
    ) -> DataFrame:
        counted = self.customer
        if other_than is not None:
            counted = counted.filter(F.col("Country") != other_than)
        return (
            counted.groupBy("Country")
            .agg(F.count("Id").alias("n"))
            .filter(F.col("n") >= at_least)
            .orderBy(F.desc("n"), "Country")
        )

    def orders_with_customer(self) -> DataFrame:
        keys = [("CustomerId", "customer_key")]
        return inner(self.order, self._customer_names_by_key(), keys).select(
            "OrderNumber", "TotalAmount", *PLACE
        )

    def total_per_customer(self) -> DataFrame:
        """Total per full name: customers of one name are one group."""
        return total_per_name(
            self.order,
            self._customer_names_by_key(),
            [("CustomerId", "customer_key")],
            ["FirstName", "LastName"],
            F.col("TotalAmount"),
            "total",
        ).orderBy(F.desc("total"), "FirstName", "LastName")

    def total_per_customer_key(self) -> DataFrame:
        """Total per customer, so that customers of one name stay apart."""
        return total_per_name(
            self.order,
            self._customer_names_by_key(),
            [("CustomerId", "customer_key")],
            ["customer_key", "FirstName", "LastName"],
            F.col("TotalAmount"),
            "total",
        ).orderBy(F.desc("total"), "customer_key")

    def customers_with_orders(self) -> DataFrame:
        """All customers with their orders, or NULLs where there is none."""
        orders = self.order.select("CustomerId", "OrderNumber", "TotalAmount")
        return (
            outer_one_to_many(
                self._customer_names_by_key(), orders, [("customer_key", "CustomerId")]
            )
            .orderBy(F.asc_nulls_first("TotalAmount"), "customer_key", "OrderNumber")
            .select(*PLACE, "OrderNumber", "TotalAmount")
        )

    def customers_with_null_total(self) -> DataFrame:
        """Customers without an order, and those with an order whose total is NULL."""
        orders = self.order.select("CustomerId", "TotalAmount")
        return outer_where_null(
            self._customer_names_by_key(), orders, [("customer_key", "CustomerId")], "TotalAmount"
        ).select(*PLACE, "TotalAmount")

    def customers_without_orders(self) -> DataFrame:
        return without_match(self.customer, self.order, [("Id", "CustomerId")])

    def order_counts(self) -> DataFrame:
        orders = self.order.select(F.col("Id").alias("order_key"), "CustomerId")
        return count_per_parent(
            self._customer_names_by_key(),
            orders,
            [("customer_key", "CustomerId")],
            "order_key",
            "OrderCount",
        ).select("FirstName", "LastName", "OrderCount")

    def customers_with_mean_between(self, low: int | Decimal, high: int | Decimal) -> DataFrame:
        return mean_per_name_between(
            self.order,
            self._customer_names_by_key(),
            [("CustomerId", "customer_key")],
            ["FirstName", "LastName"],
            F.col("TotalAmount"),
            low,
            high,
            "media",
        )

    # --- order lines and the sales view -----------------------------------------------

    def _sales_inputs(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Orders, lines and products under the names that ``plans.views`` reads."""
        orders = self.order.select(
            F.col("Id").alias("order_id"),
            F.col("OrderDate").alias("order_date"),
            F.col("CustomerId").alias("customer_id"),
            F.col("OrderNumber").alias("order_number"),
        )
        items = self.order_item.select(
            F.col("Id").alias("line_id"),
            F.col("OrderId").alias("order_id"),
            F.col("ProductId").alias("product_id"),
            F.col("Quantity").alias("quantity"),
            F.col("UnitPrice").alias("unit_price"),
        )
        products = self.product.select(
            F.col("Id").alias("product_id"), F.col("ProductName").alias("product_name")
        )
        return orders, items, products

    def sales_lines(self) -> DataFrame:
        """Order lines with order and product; the price is the line's."""
        return views.sales_lines(*self._sales_inputs())

    def _line_customers(self) -> DataFrame:
        return self.customer.select(F.col("Id").alias("customer_id"), "FirstName", "LastName")

    def order_lines(self, as_date: bool = False) -> DataFrame:
        """Lines with their order and product, by order number."""
        stamp = F.to_date("order_date").alias("Date") if as_date else F.col("order_date")
        return (
            self.sales_lines()
            .orderBy("order_number", "line_id")
            .select(
                F.col("order_number").alias("OrderNumber"),
                stamp if as_date else stamp.alias("Datetime"),
                F.col("product_name").alias("ProductName"),
                F.col("quantity").alias("Quantity"),
                F.col("unit_price").alias("UnitPrice"),
            )
        )

    def salesday(self) -> DataFrame:
        return views.salesday(self.sales_lines())

    def salesday_with_customer(self) -> DataFrame:
        return views.salesday_with_customer(
            self.sales_lines(), self._line_customers(), "FirstName", "LastName"
        )

    def salesday_sorted(self) -> DataFrame:
        return views.by_day(views.salesday(self.sales_lines(), "order_id", "line_id"))

    def sales_by_month(self) -> DataFrame:
        return views.sales_by_month(*self._sales_inputs()).orderBy("y", "m")

    def mean_sale_by_year(self) -> DataFrame:
        return views.mean_sale_by_year(*self._sales_inputs()).orderBy("y")

    def top_customers(self, n: int = 5) -> DataFrame:
        names = ["FirstName", "LastName"]
        top = views.top_customers(*self._sales_inputs(), self._line_customers(), names, n)
        return top.select(joined_text(*names).alias("customer"), "total")

    def discounted_lines(self, rate: str = "0.1") -> DataFrame:
        """Price after discount per line key, highest first."""
        value = discounted("Quantity", "UnitPrice", F.lit(rate))
        return (
            self.order_item.groupBy("Id")
            .agg(money_sum(value).alias("final_sale_value"))
            .orderBy(F.desc("final_sale_value"), "Id")
        )

    def year_against(self, year: int, bound: int) -> DataFrame:
        """Whole-number sales of a year, and whether they are greater than a bound."""
        of_year = self.orders_of_year(year).select(F.col("Id").alias("order_key"))
        sales = F.sum(F.col("UnitPrice") * F.col("Quantity"))
        label = threshold_label(
            F.col("totalsales"),
            bound,
            f"{year} sales are greater than {bound}",
            f"{year} sales are not greater than {bound}",
        )
        return (
            inner(self.order_item, of_year, [("OrderId", "order_key")])
            .agg(sales.cast("long").alias("totalsales"))
            .withColumn("message", label)
        )


def pick(df: DataFrame, columns: Sequence[str], **keys: object) -> DataFrame:
    """The row with the given key, as one-row DataFrame rather than as variables."""
    for name, value in keys.items():
        df = df.filter(F.col(name) == value)
    return df.select(*columns)
