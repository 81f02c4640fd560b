"""The insert path, statements in the audit log, the stored switch and guarded publishing."""

import pytest
from pyspark.sql import functions as F

from helpers import small_sales, tuples
from saleswright.operators.audit import (
    RUN_AUDITED,
    Statement,
    TableSwitch,
    both,
    changed_keys,
    deleting,
    inserting,
    product_log,
    read_log,
    run_audited_change,
)
from saleswright.operators.changes import (
    delete_rows,
    publish,
    run_change,
    set_table_property,
    table_property,
)
from saleswright.operators.inserting import insert_run
from saleswright.operators.key_ranges import read_ranges
from saleswright.operators.joins import rows_with_match, rows_without_match
from saleswright.sources.schemas import AUDIT, PRODUCT
from saleswright.sources.tables import drop_table, load_rows


def stamp():
    return F.lit("2024-01-02T03:04:05").cast("timestamp_ntz")


@pytest.fixture
def stored(spark, tmp_path):
    """The products in runs, and their suppliers."""
    sales = small_sales(spark)
    base = f"{tmp_path}/products"
    load_rows(sales.product, PRODUCT, base, "0")
    return base, {"Supplier": sales.supplier}


def insert(spark, stored, run, rows, columns="ProductName string, SupplierId long"):
    base, parents = stored
    new = spark.createDataFrame(rows, columns)
    order = [F.asc_nulls_first("ProductName")]
    return insert_run(spark, base, run, new, PRODUCT, order, parents)


def test_keys_and_defaults_are_given(spark, stored):
    table = insert(spark, stored, "1", [("b", 1), ("a", 2)])
    rows = table.filter("Id > 5").orderBy("Id").select("Id", "ProductName", "UnitPrice", "Package", "IsDiscontinued")
    assert [(i, n, float(p), k, d) for i, n, p, k, d in tuples(rows)] == [
        (6, "a", 0.0, None, False),
        (7, "b", 0.0, None, False),
    ]
    first = sorted(tuples(table))
    again = insert(spark, stored, "1", [("b", 1), ("a", 2)])
    assert sorted(tuples(again)) == first and again.count() == 7
    assert insert(spark, stored, "2", [("c", 3)]).agg(F.max("Id")).first()[0] == 8


def test_a_repeated_run_keeps_its_keys_after_a_later_one(spark, stored):
    insert(spark, stored, "1", [("a", 1)])
    insert(spark, stored, "2", [("c", 2), ("b", 1)])
    table = sorted(tuples(insert(spark, stored, "3", [("d", 3), ("e", 1), ("f", 1)])))
    assert [row[:2] for row in table[-6:]] == [(6, "a"), (7, "b"), (8, "c"), (9, "d"), (10, "e"), (11, "f")]
    assert sorted(tuples(insert(spark, stored, "2", [("c", 2), ("b", 1)]))) == table
    assert sorted(tuples(insert(spark, stored, "1", [("a", 1)]))) == table


def test_a_range_that_a_failed_run_reserved_is_its_own(spark, stored):
    with pytest.raises(ValueError, match="FK_PRODUCT"):
        insert(spark, stored, "1", [("a", 1), ("b", 99)])
    assert sorted(r["Id"] for r in insert(spark, stored, "2", [("c", 1)]).collect())[-1] == 8
    mended = insert(spark, stored, "1", [("a", 1), ("b", 2)])
    assert {r["Id"]: r["ProductName"] for r in mended.filter("Id > 5").collect()} == {6: "a", 7: "b", 8: "c"}
    # More rows than were reserved need a range of their own.
    more = insert(spark, stored, "1", [("a", 1), ("b", 2), ("x", 2)])
    assert sorted(r["Id"] for r in more.filter("Id > 5").collect()) == [8, 9, 10, 11]
    ranges = read_ranges(spark, stored[0]).collect()
    assert sorted((r["run_id"], r["first_key"], r["n_keys"]) for r in ranges) == [("1", 9, 3), ("2", 8, 1)]


@pytest.mark.parametrize(
    "rows, columns, message",
    [
        ([("x" * 51, 1)], "ProductName string, SupplierId long", "ProductName over 50: 1"),
        ([(None, 1)], "ProductName string, SupplierId long", "ProductName is null: 1"),
        ([("x", 9)], "ProductName string, SupplierId long", "FK_PRODUCT_REFERENCE_SUPPLIER: 1"),
        ([("x", None)], "ProductName string, SupplierId long", "SupplierId is null: 1"),
        ([("x", 1, 3)], "ProductName string, SupplierId long, Id long", "Id repeated: 1"),
        ([("x", 1, 8), ("y", 1, 8)], "ProductName string, SupplierId long, Id long", "Id repeated: 1"),
        ([("x", 1, None)], "ProductName string, SupplierId long, Id long", "Id is null: 1"),
    ],
)
def test_a_row_that_breaks_a_rule_stops_the_run(spark, stored, rows, columns, message):
    with pytest.raises(ValueError, match=message):
        insert(spark, stored, "1", rows, columns)
    assert insert(spark, stored, "2", [("ok", 1)]).count() == 6


def test_a_load_takes_defaults(spark, tmp_path):
    rows = spark.sql("SELECT 1L AS Id, 'a' AS ProductName, 1L AS SupplierId")
    row = load_rows(rows, PRODUCT, f"{tmp_path}/t", "1").first()
    assert (float(row["UnitPrice"]), row["IsDiscontinued"], row["Package"]) == (0.0, False, None)


# --- published tables -----------------------------------------------------------------


@pytest.fixture
def table(spark, tmp_path):
    name, base = f"table_{tmp_path.name}", str(tmp_path)
    small_sales(spark).product.write.parquet(f"{base}/first")
    run_change(spark, name, base, "0", lambda old: old, f"{base}/first")
    yield name, base
    drop_table(spark, name)


def test_a_change_that_came_in_between_is_not_undone(spark, table):
    name, base = table
    first = spark.catalog.getTable(name) and f"{base}/snapshot-0"

    def slow(old):
        run_change(spark, name, base, "B", lambda rows: delete_rows(rows, F.col("Id") == 2))
        return delete_rows(old, F.col("Id") == 1)

    with pytest.raises(ValueError, match="moved on"):
        run_change(spark, name, base, "A", slow)
    assert sorted(r.Id for r in spark.table(name).collect()) == [1, 3, 4, 5]
    with pytest.raises(ValueError, match="moved on"):
        publish(spark, name, f"{base}/other", first)


def logged(spark, base):
    rows = read_log(spark, f"{base}/log", AUDIT.schema).orderBy("id").collect()
    return [(r["id"], r["productid"], r["productname"], r["operation"]) for r in rows]


def change(spark, table, run, make, switch=None):
    name, base = table
    return run_audited_change(
        spark, name, base, run, make, "Id", f"{base}/log", stamp(),
        switch or TableSwitch(spark), shape=product_log(spark, f"{base}/log", run),
    )


def replaced(old) -> Statement:
    """Key 1 goes and comes back as another product."""
    back = old.filter("Id = 1").withColumn("ProductName", F.lit("new"))
    return both(deleting(old, F.col("Id") == 1), lambda left: inserting(left, back, PRODUCT))


def test_the_log_has_the_statements_own_rows(spark, table):
    for _ in range(2):
        change(spark, table, "1", replaced)
    assert logged(spark, table[1]) == [(1, 1, "Chai", "DEL"), (2, 1, "new", "INS")]
    change(spark, table, "2", lambda old: deleting(old, F.col("Id") > 4))
    assert logged(spark, table[1])[2:] == [(3, 5, "Zu", "DEL")]
    read_schema = read_log(spark, f"{table[1]}/log", AUDIT.schema).columns
    assert read_schema == AUDIT.schema.names


def test_the_switch_is_kept_with_the_table(spark, table):
    name, base = table
    TableSwitch(spark).disable(name)
    other = spark.newSession()
    assert not TableSwitch(other).is_on(name)
    change(spark, table, "1", replaced)
    TableSwitch(other).enable(name)
    assert TableSwitch(spark).is_on(name)
    change(spark, table, "1", replaced)  # a repeated run does as was decided
    assert table_property(spark, name, RUN_AUDITED) == "no: 1"
    change(spark, table, "2", lambda old: deleting(old, F.col("Id") == 3))
    assert [row[1:] for row in logged(spark, base)] == [(3, "Chang", "DEL")]
    set_table_property(spark, name, "note", "it's \\ fine")
    assert table_property(spark, name, "note") == "it's \\ fine"
    TableSwitch(spark).disable_all([name])
    assert not TableSwitch(spark).is_on(name)
    TableSwitch(spark).enable_all([name])
    assert TableSwitch(spark).is_on(name) and TableSwitch(spark).is_on("no_such_table")


def test_changed_keys_need_no_join(spark):
    old = spark.createDataFrame([(1,), (2,), (None,), (None,)], "k int")
    new = spark.createDataFrame([(2,), (3,), (3,), (None,)], "k int")
    found = changed_keys(old, new, "k")
    assert sorted(tuples(found)) == [(1, "DEL"), (3, "INS")]
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_matches_for_a_hot_left_key(spark):
    left = spark.createDataFrame([(1, i) for i in range(50)] + [(2, 0), (None, 1)], "k int, v int")
    right = spark.createDataFrame([(1,), (3,)], "r int")
    keys = [("k", "r")]
    assert rows_with_match(left, right, keys).count() == 50
    assert sorted(tuples(rows_without_match(left, right, keys)), key=str) == [(2, 0), (None, 1)]
    text = rows_with_match(left, right, keys)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in text
