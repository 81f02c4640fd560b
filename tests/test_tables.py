"""Schemas, loading, copies and staging."""

from datetime import UTC, datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from helpers import SUPPLIERS, as_set, frame, small_sales, tuples
from saleswright.functions.scalar import stamp_as_text, stamp_from_text
from saleswright.plans.sales import Sales
from saleswright.session import clear_scratch, scratch_path, shared_folder
from saleswright.sources.schemas import (
    AUDIT,
    ORDER,
    ORDER_ITEM,
    PRODUCT,
    SUPPLIER,
    TABLES,
    complete_rows,
    require_schema,
    schema_drift,
)
from saleswright.sources.tables import (
    bulk_load,
    create_table,
    drop_staged_for_all,
    drop_table,
    empty_table,
    fingerprint,
    load_rows,
    named_column,
    quoted_name,
    read_declared,
    read_named_table,
    read_runs,
    read_table,
    select_into,
    stage_for_all,
    stage_for_session,
    write_run,
)

# --- schemas --------------------------------------------------------------------------


def test_declared_tables():
    assert {name: spec.schema.names for name, spec in TABLES.items()} == {
        "Customer": ["Id", "FirstName", "LastName", "City", "Country", "Phone"],
        "Supplier": [
            "Id", "CompanyName", "ContactName", "ContactTitle", "City", "Country", "Phone", "Fax"
        ],
        "Product": ["Id", "ProductName", "SupplierId", "UnitPrice", "Package", "IsDiscontinued"],
        "Order": ["Id", "OrderDate", "OrderNumber", "CustomerId", "TotalAmount"],
        "OrderItem": ["Id", "OrderId", "ProductId", "UnitPrice", "Quantity"],
    }
    for spec in TABLES.values():
        keys = [spec.key, *[reference.column for reference in spec.foreign_keys]]
        assert {spec.schema[key].dataType.simpleString() for key in keys} == {"bigint"}
    assert PRODUCT.schema["UnitPrice"].dataType.simpleString() == "decimal(12,2)"
    assert PRODUCT.schema["IsDiscontinued"].dataType.simpleString() == "boolean"
    assert ORDER.required == ["Id", "OrderDate", "CustomerId"]
    assert ORDER_ITEM.required == ["Id", "OrderId", "ProductId", "UnitPrice", "Quantity"]
    references = [key for spec in TABLES.values() for key in spec.foreign_keys]
    assert len(references) == 4


def test_audit_log_allows_null_where_products_do():
    product = {f.name.lower(): f.nullable for f in PRODUCT.schema.fields}
    for f in AUDIT.schema.fields:
        if f.name.lower() in product and f.name != "id":
            assert f.nullable == product[f.name.lower()], f.name
    assert AUDIT.schema.names[-2:] == ["updatedat", "operation"]


def test_drift_names_each_difference(spark):
    df = spark.sql("SELECT 1L AS Id, 'x' AS Extra")
    schema = StructType().add("Id", IntegerType(), False).add("Name", "string")
    assert schema_drift(df, schema) == [
        "Name: missing",
        "Extra: not declared",
        "Id: bigint instead of int",
    ]
    with pytest.raises(ValueError, match="schema drift"):
        require_schema(df, schema)


def test_read_declared_refuses_another_type(spark, tmp_path):
    small = small_sales(spark)
    small.supplier.write.parquet(f"{tmp_path}/good")
    assert read_declared(spark, f"{tmp_path}/good", SUPPLIER).count() == 3
    small.supplier.withColumn("Id", F.col("Id").cast("int")).write.parquet(f"{tmp_path}/bad")
    with pytest.raises(ValueError, match="Id: int instead of bigint"):
        read_declared(spark, f"{tmp_path}/bad", SUPPLIER)


def test_defaults_stand_only_for_columns_left_out(spark):
    given = spark.sql("SELECT 1 AS Id, 'a' AS ProductName, 1 AS SupplierId, NULL AS UnitPrice")
    row = complete_rows(given, PRODUCT.schema, PRODUCT.defaults).collect()[0]
    assert (row.UnitPrice, row.Package, row.IsDiscontinued) == (None, None, False)
    left_out = given.drop("UnitPrice")
    row = complete_rows(left_out, PRODUCT.schema, PRODUCT.defaults).collect()[0]
    assert row.UnitPrice == Decimal("0.00")


def test_order_date_defaults_to_now(spark):
    given = spark.sql("SELECT 1 AS Id, 1 AS CustomerId")
    row = complete_rows(given, ORDER.schema, ORDER.defaults).collect()[0]
    assert abs((datetime.now(UTC).replace(tzinfo=None) - row.OrderDate).total_seconds()) < 3600
    assert row.TotalAmount == Decimal("0.00")


def test_unknown_columns_are_refused(spark):
    with pytest.raises(ValueError, match="not in the table"):
        complete_rows(spark.sql("SELECT 1 AS Nope"), PRODUCT.schema)


def test_catalogue_tables_fill_defaults_and_limit_text(spark):
    for spec in (*TABLES.values(), AUDIT):
        spark.sql(f"DROP TABLE IF EXISTS {quoted_name(spec.name)}")
        assert schema_drift(create_table(spark, spec), spec.schema) == []
    spark.sql("INSERT INTO Product (Id, ProductName, SupplierId) VALUES (1, 'Chai', 1)")
    assert tuples(spark.table("Product")) == [(1, "Chai", 1, Decimal("0.00"), None, False)]
    spark.sql("INSERT INTO OrderItem (Id, OrderId, ProductId) VALUES (1, 1, 1)")
    assert tuples(spark.table("OrderItem")) == [(1, 1, 1, Decimal("0.00"), 1)]
    spark.sql("INSERT INTO `Order` (Id, CustomerId) VALUES (1, 1)")
    assert spark.table("`Order`").filter("OrderDate IS NOT NULL AND TotalAmount = 0").count() == 1
    spark.sql("INSERT INTO Product (Id, UnitPrice) VALUES (2, NULL)")
    assert spark.table("Product").filter("UnitPrice IS NULL").count() == 1
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        spark.sql(f"INSERT INTO Product (Id, ProductName) VALUES (3, '{'x' * 51}')")
    spark.sql("TRUNCATE TABLE Product")
    assert spark.table("Product").count() == 0
    for spec in (*TABLES.values(), AUDIT):
        drop_table(spark, spec.name)


# --- loading --------------------------------------------------------------------------


@pytest.mark.parametrize("file_format", ["csv", "json", "parquet"])
def test_bulk_load_keeps_keys(spark, tmp_path, file_format):
    given = ["Id", "CompanyName", "City", "Fax"]
    rows = frame(spark, SUPPLIERS, SUPPLIER.schema).select(*given)
    rows.write.format(file_format).save(f"{tmp_path}/files")
    loaded = bulk_load(
        spark, f"{tmp_path}/files", SUPPLIER, f"{tmp_path}/t", "1", given, file_format
    )
    assert schema_drift(loaded, SUPPLIER.schema) == []
    assert as_set(loaded.select(*given)) == as_set(rows)
    assert loaded.filter("ContactTitle IS NOT NULL").count() == 0


def test_a_repeated_load_replaces_itself_and_another_adds(spark, tmp_path):
    rows = frame(spark, SUPPLIERS, SUPPLIER.schema)
    rows.write.json(f"{tmp_path}/files")
    for load, expected in (("1", 3), ("1", 3), ("2", 6)):
        loaded = bulk_load(
            spark, f"{tmp_path}/files", SUPPLIER, f"{tmp_path}/t", load, None, "json"
        )
        assert loaded.count() == expected


def test_rows_of_any_source_load(spark, tmp_path):
    rows = spark.sql("SELECT 7L AS Id, 'Acme' AS CompanyName, 'Leeds' AS City")
    loaded = load_rows(rows, SUPPLIER, f"{tmp_path}/t", "1")
    assert tuples(loaded) == [(7, "Acme", None, None, "Leeds", None, None, None)]
    assert schema_drift(loaded, SUPPLIER.schema) == []


def test_a_row_of_another_type_stops_the_load(spark, tmp_path):
    spark.sql("SELECT 'x' AS Id, 'Acme' AS CompanyName").write.csv(f"{tmp_path}/files")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot hold"):
        bulk_load(
            spark, f"{tmp_path}/files", SUPPLIER, f"{tmp_path}/t", "1", ["Id", "CompanyName"]
        )


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_misfit_stops_the_load_in_both_cast_modes(spark, tmp_path, set_conf, ansi):
    set_conf(spark__sql__ansi__enabled=ansi)
    spark.sql("SELECT 1 AS Id, 'Chai' AS ProductName, 'dear' AS UnitPrice").write.json(
        f"{tmp_path}/files"
    )
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot hold dear"):
        bulk_load(
            spark,
            f"{tmp_path}/files",
            PRODUCT,
            f"{tmp_path}/t",
            "1",
            ["Id", "ProductName", "UnitPrice"],
            "json",
        )


@pytest.mark.parametrize("file_format", ["csv", "json"])
def test_flags_and_stamps_as_text(spark, tmp_path, file_format):
    spark.sql("SELECT * FROM VALUES (1, 'Chai', 1, 18.005, 'box', 0), (2, 'Zu', 1, 2.5, NULL, 1)"
              " t(Id, ProductName, SupplierId, UnitPrice, Package, IsDiscontinued)").write.format(
        file_format
    ).save(f"{tmp_path}/p")
    products = bulk_load(
        spark, f"{tmp_path}/p", PRODUCT, f"{tmp_path}/pt", "1", file_format=file_format
    )
    assert as_set(products) == {
        (1, "Chai", 1, Decimal("18.01"), "box", False),
        (2, "Zu", 1, Decimal("2.50"), None, True),
    }
    spark.sql("SELECT * FROM VALUES (1, 'Jul  4 2012 12:00:00:000AM'), (2, '2013-12-31T23:59:59')"
              " t(Id, OrderDate)").write.format(file_format).save(f"{tmp_path}/o")
    orders = bulk_load(
        spark, f"{tmp_path}/o", ORDER, f"{tmp_path}/ot", "1", ["Id", "OrderDate"], file_format
    )
    assert as_set(orders.select("Id", "OrderDate")) == {
        (1, datetime(2012, 7, 4)),
        (2, datetime(2013, 12, 31, 23, 59, 59)),
    }


def test_order_text_becomes_a_stamp(spark):
    text = spark.sql(
        "SELECT * FROM VALUES ('Jul  4 2012 12:00:00:000AM'), ('Dec 31 2013 11:59:59:123PM') t(t)"
    )
    stamps = text.select(stamp_from_text("t").alias("ts")).orderBy("ts")
    found = [row[0] for row in stamps.collect()]
    assert found == [datetime(2012, 7, 4), datetime(2013, 12, 31, 23, 59, 59, 123000)]
    back = text.select(stamp_as_text(stamp_from_text("t")).alias("b"), "t")
    assert back.filter("b <> t").count() == 0


def test_five_tables_round_trip(spark, tmp_path):
    small = small_sales(spark)
    for name, df in small.by_name().items():
        df.write.parquet(f"{tmp_path}/{name}")
    again = Sales.read(spark, str(tmp_path))
    for name, df in again.by_name().items():
        assert as_set(df) == as_set(small.by_name()[name])
    assert dict(tuples(again.row_counts())) == {
        "Customer": 5, "Supplier": 3, "Product": 5, "Order": 5, "OrderItem": 5
    }


def test_loaded_tables_are_read_as_declared(spark, tmp_path):
    small = small_sales(spark)
    for name, df in small.by_name().items():
        df.write.json(f"{tmp_path}/files/{name}")
        bulk_load(
            spark, f"{tmp_path}/files/{name}", TABLES[name], f"{tmp_path}/{name}", "7", None, "json"
        )
    again = Sales.read(spark, str(tmp_path))
    for name, df in again.by_name().items():
        assert as_set(df) == as_set(small.by_name()[name])


# --- copies ---------------------------------------------------------------------------


def test_select_into_refuses_an_existing_table(spark, tmp_path):
    rows = spark.range(10)
    assert select_into(rows, f"{tmp_path}/t").count() == 10
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        select_into(rows, f"{tmp_path}/t")


def test_copy_has_the_same_fingerprint(spark, data, tmp_path):
    lines = spark.read.parquet(f"{data}/lineitem.parquet")
    copy = select_into(lines.repartition(7), f"{tmp_path}/copy")
    assert tuples(fingerprint(lines)) == tuples(fingerprint(copy))
    changed = copy.withColumn(
        "l_tax", F.when(F.col("l_linenumber") == 1, 9.0).otherwise(F.col("l_tax"))
    )
    assert tuples(fingerprint(lines)) != tuples(fingerprint(changed))


def test_empty_table_keeps_the_schema(spark, tmp_path):
    df = small_sales(spark).product
    emptied = empty_table(df, f"{tmp_path}/t")
    assert emptied.count() == 0
    assert emptied.schema == df.schema
    assert spark.read.parquet(f"{tmp_path}/t").schema == df.schema


def test_runs_with_number_like_names_stay_apart(spark, tmp_path):
    for run in ("01", "1"):
        write_run(spark.range(2), str(tmp_path), run)
    assert read_runs(spark, str(tmp_path), spark.range(1).schema).count() == 4


# --- staging --------------------------------------------------------------------------


def test_session_staging_is_not_seen_by_another_session(spark):
    other = spark.newSession()
    staged = stage_for_session(small_sales(spark).price_list(), "temp_local")
    assert staged.count() == spark.table("temp_local").count() == 5
    with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_NOT_FOUND"):
        other.table("temp_local")


def test_global_staging_is_seen_by_all_until_dropped(spark):
    other = spark.newSession()
    stage_for_all(small_sales(spark).price_list(), "temp_global")
    assert other.table("global_temp.temp_global").count() == 5
    assert drop_staged_for_all(spark, "temp_global")
    with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_NOT_FOUND"):
        other.table("global_temp.temp_global")


def test_a_table_name_cannot_carry_a_statement(spark):
    stage_for_session(spark.range(3), "victim")
    assert read_named_table(spark, "victim").count() == 3
    for name in ("victim;DROP VIEW victim", "victim` UNION SELECT 1 --", "victim WHERE 1=0"):
        with pytest.raises(AnalysisException):
            read_named_table(spark, name)
    assert spark.table("victim").count() == 3
    assert quoted_name("a", "b`c") == "`a`.`b``c`"


def test_a_column_name_must_be_a_column(spark):
    df = spark.range(3)
    assert df.orderBy(named_column(df, "id").desc()).first().id == 2
    with pytest.raises(ValueError, match="no column"):
        named_column(df, "id; DROP")


# --- the shared folder ----------------------------------------------------------------


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert scratch_path(spark, "x").startswith(folder)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_cluster_must_name_its_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_without_a_folder_the_warehouse_is_used():
    class Context:
        master = "local[4]"
        folder = None

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Conf:
        def get(self, key, default):
            return "file:/w" if key == "spark.sql.warehouse.dir" else default

    class Session:
        sparkContext = Context()
        conf = Conf()

    assert shared_folder(Session()) == "file:/w/_scratch"
    Session.sparkContext.folder = None
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_scratch_can_be_cleared(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    clear_scratch(spark)
    with pytest.raises(AnalysisException):
        spark.read.parquet(path).count()


def test_a_rewritten_table_shows_its_new_column(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    spark.range(2).write.parquet(path)
    assert read_table(spark, str(tmp_path), "t").columns == ["id"]
    spark.range(2).withColumn("more", F.lit(1)).write.mode("overwrite").parquet(path)
    assert read_table(spark, str(tmp_path), "t").columns == ["id", "more"]
