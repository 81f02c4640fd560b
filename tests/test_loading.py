"""Checked loads: what is rejected and why, cascades, repeated loads, and stopping."""

from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import as_set, plan, small_sales, tuples
from saleswright.operators.rules import BrokenRules
from saleswright.sources import loading
from saleswright.sources.loading import (
    Files,
    bucket_order_lines,
    judged_rows,
    load_tables,
    parsed_rows,
    read_rejects,
)
from saleswright.sources.schemas import CUSTOMER, ORDER, ORDER_ITEM, PRODUCT, SUPPLIER, TABLES
from saleswright.sources.tables import read_runs


@pytest.fixture
def files(tmp_path):
    def write(name, text, given=None, file_format="csv", **options):
        folder = tmp_path / f"{name}-{len(list(tmp_path.iterdir()))}"
        folder.mkdir()
        (folder / f"part.{file_format}").write_text(text, encoding="utf-8")
        return Files(str(folder), given, file_format, options)

    return write


def faults(spark, source, spec):
    rows = parsed_rows(spark, source, spec).collect()
    return {r["_record"]: r["_faults"] for r in rows}


def test_rows_are_judged_by_their_text(spark, files):
    text = '1,Chai,1,18.5,box,0\n2,,x,dear,box,2\n3,Zu\n4,' + "z" * 51 + ',1,,,1\n,Ok,1,1,b,true\n5,a,1,1,b,0,more\n'
    found = faults(spark, files("p", text), PRODUCT)
    by_key = {(r.split(",")[0] if "," in r and "{" not in r else r): f for r, f in found.items()}
    reasons = sorted(map(tuple, found.values()))
    assert reasons == sorted([
        (),
        ("ProductName is null", "SupplierId cannot hold its text", "UnitPrice cannot hold its text", "IsDiscontinued cannot hold its text"),
        ("malformed",),
        ("ProductName over 50",),
        ("Id is null",),
        ("malformed",),
    ])
    assert "3,Zu" in by_key or any("3,Zu" in r for r in found)  # a malformed line is kept as it came


def test_json_and_stamps(spark, files):
    text = (
        '{"Id": 1, "OrderDate": "Jul  4 2012 12:00:00:000AM", "CustomerId": 1}\n'
        '{"Id": 2, "OrderDate": "2013-01-05T10:00:00", "CustomerId": 1, "TotalAmount": 5.5}\n'
        '{"Id": 3, "OrderDate": "Feb 30 2012 12:00:00:000AM", "CustomerId": 1}\n'
        '{"Id": 4, "OrderDate": "soon", "CustomerId": 99999999999999999999}\n'
        '{"Id": 5, "OrderDate"\n'
    )
    rows = parsed_rows(spark, files("o", text, file_format="json"), ORDER).collect()
    assert [r["OrderDate"] for r in rows[:3]] == [datetime(2012, 7, 4), datetime(2013, 1, 5, 10), None]
    assert [list(r["_faults"]) for r in rows] == [
        [], [], ["OrderDate cannot hold its text"],
        ["OrderDate cannot hold its text", "CustomerId cannot hold its text"], ["malformed"],
    ]


def source_files(files):
    return {
        "OrderItem": files("i", "1,1,1,5,2\n2,1,9,5,2\n3,2,1,5,2\n4,1,1,5,2\n4,1,1,5,3\n5,,1,5,2\n"),
        "Order": files("o", "1,2012-07-04,1,1,5\n2,2012-07-05,2,3,5\n3,2012-07-05,3,9,5\n"),
        "Product": files("p", "1,Chai,1,18,box,0\n2,Zu,2,18,box,0\n", None),
        "Supplier": files("s", "1,Acme\nx,Bolt\n", ["Id", "CompanyName"]),
        "Customer": files("c", "1,Ana,Sá\n2,Joe,Low\n3,Kim,\n", ["Id", "FirstName", "LastName"]),
    }


EXPECTED = {
    ("Customer", None, 2),
    ("Customer", "LastName is null", 1),
    ("Supplier", None, 1),
    ("Supplier", "Id cannot hold its text", 1),
    ("Product", None, 1),
    ("Product", "FK_PRODUCT_REFERENCE_SUPPLIER", 1),
    ("Order", None, 1),
    ("Order", "FK_ORDER_REFERENCE_CUSTOMER", 2),
    ("OrderItem", None, 1),
    ("OrderItem", "FK_ORDERITE_REFERENCE_PRODUCT", 1),
    ("OrderItem", "FK_ORDERITE_REFERENCE_ORDER", 1),
    ("OrderItem", "Id repeated", 2),
    ("OrderItem", "OrderId is null", 1),
}


def test_a_load_rejects_what_breaks_a_rule_and_what_refers_to_it(spark, files, tmp_path):
    base = f"{tmp_path}/t"
    sources = source_files(files)
    for _ in range(2):  # a repeated load replaces its runs and its rejects
        assert as_set(load_tables(spark, sources, base, "1")) == EXPECTED
        assert {n: read_runs(spark, f"{base}/{n}", s.schema).count() for n, s in TABLES.items()} == {
            "Customer": 2, "Supplier": 1, "Product": 1, "Order": 1, "OrderItem": 1
        }
        assert read_rejects(spark, base).count() == 10
    record = read_rejects(spark, base).filter("table_name = 'Supplier'").first()["record"]
    assert record == '{"Id":"x","CompanyName":"Bolt"}'


def test_a_second_load_meets_the_first(spark, files, tmp_path):
    base = f"{tmp_path}/t"
    load_tables(spark, source_files(files), base, "1")
    more = {
        "Customer": files("c", "1,Again,X\n3,Kim,Roe\n", ["Id", "FirstName", "LastName"]),
        "Order": files("o", "2,2012-07-05,2,3,5\n4,2012-07-05,4,1,5\n"),
    }
    assert as_set(load_tables(spark, more, base, "2")) == {
        ("Customer", None, 1), ("Customer", "Id repeated", 1), ("Order", None, 2)
    }
    assert sorted(r["Id"] for r in read_runs(spark, f"{base}/Order", ORDER.schema).collect()) == [1, 2, 4]


def test_stopping_writes_nothing_of_that_table(spark, files, tmp_path):
    base = f"{tmp_path}/t"
    source = files("s", "1,Acme\n1,Bolt\n2,\n", ["Id", "CompanyName"])
    with pytest.raises(BrokenRules) as stopped:
        load_tables(spark, {"Supplier": source}, base, "1", stop=True)
    assert stopped.value.faults == {"Id repeated": 2, "CompanyName is null": 1}
    good = files("s", "1,Acme\n2,Bolt\n", ["Id", "CompanyName"])
    assert as_set(load_tables(spark, {"Supplier": good}, base, "1", stop=True)) == {("Supplier", None, 2)}


def test_empty_files_and_typed_files(spark, files, tmp_path):
    base = f"{tmp_path}/t"
    small = small_sales(spark)
    small.customer.write.parquet(f"{tmp_path}/customer-files")
    sources = {"Customer": Files(f"{tmp_path}/customer-files", None, "parquet"), "Supplier": files("s", "", ["Id", "CompanyName"])}
    assert as_set(load_tables(spark, sources, base, "1")) == {("Customer", None, 5)}
    assert as_set(read_runs(spark, f"{base}/Customer", CUSTOMER.schema)) == as_set(small.customer)
    assert read_runs(spark, f"{base}/Supplier", SUPPLIER.schema).count() == 0


def test_a_record_is_stored_only_where_values_do_not_give_it(spark, files, tmp_path, monkeypatch):
    stored, real = {}, loading._written
    monkeypatch.setattr(loading, "_written", lambda df, label: stored.setdefault(label, real(df, label)))
    plain = [f"{i},2012-07-04 00:00:0{i},\"a, \"\"{i}\",9,5.00" for i in range(4)]
    odd = ["04,2012-07-04,x,9,5", "5,soon,,9,5.00", "6,2012-07-04 00:00:00,x", "7,,x,9,+5.00"]
    small_sales(spark).product.write.parquet(f"{tmp_path}/product-files")
    sources = {
        "Order": files("o", "\n".join(plain + odd) + "\n"),
        "OrderItem": files("i", '{"Id": 1, "OrderId": 2, "Quantity": 3}\n{"Id": 2, "OrderId": 2.0}\n', ["Id", "OrderId", "Quantity"], "json"),
        "Product": Files(f"{tmp_path}/product-files", None, "parquet"),
    }
    load_tables(spark, sources, f"{tmp_path}/t", "1")
    for name, odd_ones, rows in (("Order", 4, 8), ("OrderItem", 1, 2), ("Product", 0, 5)):
        for step in ("parsed", "judged"):
            assert stored[f"{step}-{name}"].filter("_record IS NOT NULL").count() == odd_ones
        whole = parsed_rows(spark, sources[name], TABLES[name])
        rejected = read_rejects(spark, f"{tmp_path}/t").filter(F.col("table_name") == name)
        found = sorted(r["record"] for r in rejected.collect())  # all refer to what is not there
        assert found == sorted(r["_record"] for r in whole.collect()) and len(found) == rows


def test_a_hot_reference_is_split(spark, set_conf):
    set_conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    rows = spark.range(0, 30000, 1, 8).select(
        F.col("id").alias("Id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 900).cast("long").alias("OrderId"),
        (F.col("id") % 50).alias("ProductId"),
        F.lit(1).cast("decimal(12,2)").alias("UnitPrice"),
        F.lit(1).alias("Quantity"),
        F.array().cast("array<string>").alias("_faults"),
        F.sha2(F.col("id").cast("string"), 512).alias("_record"),
    )
    key = spark.range(0, 1000).withColumnRenamed("id", "Id")
    judged = judged_rows(rows, ORDER_ITEM, rows.select(ORDER_ITEM.key).limit(0), {"Order": key, "Product": key})
    assert len(judged.filter("size(_faults) = 0").collect()) == 30000
    judged = judged.filter("size(_faults) = 0")
    judged.collect()
    assert "skew=true" in plan(judged)


@pytest.mark.parametrize("few", [0, 1 << 21])
def test_rows_are_not_shuffled_to_find_few_faults(spark, set_conf, monkeypatch, few):
    """A threshold of a byte lets Spark broadcast nothing by its estimate."""
    set_conf(spark__sql__autoBroadcastJoinThreshold="1b", spark__sql__adaptive__autoBroadcastJoinThreshold="1b")
    monkeypatch.setattr(loading, "_FEW", few)
    rows = spark.range(0, 1000, 1, 4).select(
        (F.col("id") - F.when(F.col("id") % 100 == 1, 1).otherwise(0)).alias("Id"),
        F.when(F.col("id") % 9 != 0, F.col("id") % 90).alias("OrderId"),
        (F.col("id") % 50).alias("ProductId"),
        F.lit(1).cast("decimal(12,2)").alias("UnitPrice"),
        F.lit(1).alias("Quantity"),
        F.when(F.col("id") < 5, F.array(F.lit("own"))).otherwise(F.array().cast("array<string>")).alias("_faults"),
        F.lit(None).cast("string").alias("_record"),
    )
    orders, products = (spark.range(n).withColumnRenamed("id", "Id") for n in (80, 45))
    existing = spark.range(990, 2000).withColumnRenamed("id", "Id")
    judged = judged_rows(rows, ORDER_ITEM, existing, {"Order": orders, "Product": products})
    wanted = Counter()
    for i in range(1000):
        key = i - (i % 100 == 1)
        repeated = (i % 100 < 2 and i > 1) or key >= 990
        lost = ["FK_ORDERITE_REFERENCE_ORDER"] * (i % 9 != 0 and i % 90 >= 80)
        lost += ["FK_ORDERITE_REFERENCE_PRODUCT"] * (i % 50 >= 45)
        wanted[("own",) if i < 5 else tuple(["Id repeated"] * repeated + lost)] += 1
    assert Counter(tuple(r["_faults"]) for r in judged.collect()) == wanted
    assert ("Exchange hashpartitioning" in plan(judged)) == (few == 0)


def test_loaded_orders_and_lines_can_be_bucketed(spark, files, tmp_path):
    base = f"{tmp_path}/t"
    load_tables(spark, source_files(files), base, "1")
    tables = bucket_order_lines(spark, base, 4)
    assert tuples(tables.joined({"order": "Id"}, {"line": "Id"})) == [(1, 1)]
