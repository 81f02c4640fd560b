"""Row changes, numbering, publishing and the audit log."""

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import D, as_set, frame, plan, small_sales, tuples
from saleswright.operators.audit import (
    TableSwitch,
    append_log,
    logged,
    read_log,
    row_sets_log,
    run_audited_change,
    snapshot_log,
)
from saleswright.operators.changes import (
    current_location,
    delete_rows,
    delete_through_view,
    insert_rows,
    insert_through_view,
    run_change,
    update_rows,
)
from saleswright.operators.numbering import assign_ids, number_rows
from saleswright.sources.schemas import CUSTOMER, PRODUCT, schema_drift

STAMP = datetime(2024, 5, 6, 7, 8, 9)

few_examples = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def stamp():
    return F.lit(STAMP.isoformat()).cast("timestamp_ntz")


# --- updates, deletes, inserts --------------------------------------------------------


def test_update_reads_only_old_values(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS b")
    swapped = update_rows(df, {"a": F.col("b"), "b": F.col("a")})
    assert tuples(swapped) == [(2, 1)]
    moved = update_rows(df, {"a": F.lit(9), "b": F.lit(8)}, F.col("a") == 1)
    assert tuples(moved) == [(9, 8)]


def test_update_leaves_rows_with_a_null_condition(spark):
    product = small_sales(spark).product
    chosen = update_rows(product, {"ProductName": F.lit("TESTE")}, F.col("UnitPrice") > 0)
    assert {r.Id for r in chosen.filter("ProductName <> 'TESTE'").collect()} == {4}
    assert chosen.schema == product.schema


def test_update_keeps_types_and_refuses_unknown_columns(spark):
    product = small_sales(spark).product
    changed = update_rows(product, {"IsDiscontinued": F.lit(1), "UnitPrice": F.lit(97)})
    assert schema_drift(changed, PRODUCT.schema) == []
    assert changed.filter("IsDiscontinued AND UnitPrice = 97.00").count() == 5
    with pytest.raises(ValueError, match="not in the table"):
        update_rows(product, {"Name": F.lit("x")})


def test_delete_keeps_rows_with_a_null_condition(spark):
    product = small_sales(spark).product
    assert {r.Id for r in delete_rows(product, F.col("UnitPrice") > 0).collect()} == {4}
    assert delete_rows(product).count() == 0
    assert delete_rows(product).schema == product.schema


def test_insert_fills_columns_left_out(spark):
    product = small_sales(spark).product
    row = spark.sql("SELECT 9 AS Id, 'New' AS ProductName, 1 AS SupplierId")
    added = insert_rows(product, row, PRODUCT.defaults).filter("Id = 9")
    assert tuples(added) == [(9, "New", 1, D("0.00"), None, False)]
    with pytest.raises(ValueError, match="not in the table"):
        insert_rows(product, row.withColumn("Nope", F.lit(1)))


@few_examples
@given(keys=st.sets(st.integers(0, 30)), doomed=st.sets(st.integers(0, 30)))
def test_delete_then_insert_restores(spark, keys, doomed):
    df = spark.createDataFrame([(k, f"n{k}") for k in keys], "k int, name string")
    gone = df.filter(F.col("k").isin(*doomed))
    left = delete_rows(df, F.col("k").isin(*doomed))
    assert {r.k for r in left.collect()} == keys - doomed
    assert as_set(insert_rows(left, gone)) == as_set(df)


def test_changes_through_a_view(spark):
    customer = small_sales(spark).customer
    in_city = F.col("City") == "São Paulo"
    rows = frame(
        spark,
        [
            (6, "Joao", "Carvalho", "São Paulo", "Brazil", "(11)5555-5555"),
            (7, "Jose", "Martinez", "Tijuana", "México", "(55) 9999-5555"),
            (8, "Max", "Moe", None, None, None),
        ],
        CUSTOMER.schema,
    )
    inserted = insert_through_view(customer, rows, in_city)
    seen = {r.Id: r.visible for r in inserted.collect()}
    assert [seen[k] for k in (1, 6, 7, 8)] == [True, True, False, False]
    table = inserted.drop("visible")
    # The view does not show Martinez, so a delete through it cannot reach that row.
    names = F.col("LastName").isin("Martinez", "Carvalho")
    assert {r.Id for r in delete_through_view(table, in_city, names).collect()} == {
        1, 2, 3, 4, 5, 7, 8
    }
    assert {r.Id for r in delete_through_view(table, in_city).collect()} == {2, 3, 4, 5, 7, 8}


# --- numbering ------------------------------------------------------------------------


def test_numbers_are_dense_and_in_order_over_many_partitions(spark, set_conf):
    set_conf(
        spark__sql__shuffle__partitions="13",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    rows = spark.range(0, 5000, 1, 7).select(
        # Half of the rows share one sort value.
        F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 11).alias("v"), "id"
    )
    numbered = number_rows(rows, [F.desc("v"), F.asc("id")])
    found = [(r.v, r.id, r.rn) for r in numbered.collect()]
    expected = sorted(((r.v, r.id) for r in rows.collect()), key=lambda t: (-t[0], t[1]))
    assert found == [(v, i, n) for n, (v, i) in enumerate(expected, 1)]
    sizes = numbered.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 13
    assert max(r["count"] for r in sizes) < 2000


def test_numbering_nothing(spark):
    assert number_rows(spark.range(0), [F.asc("id")]).count() == 0


def test_ids_start_above_the_highest(spark):
    rows = spark.sql("SELECT * FROM VALUES ('b'), ('a'), ('c') t(name)")
    existing = spark.sql("SELECT * FROM VALUES (7), (NULL), (3) t(Id)")
    found = assign_ids(rows, existing, "Id", [F.asc("name")])
    assert tuples(found) == [("a", 8), ("b", 9), ("c", 10)]
    first = assign_ids(rows, existing.limit(0), "Id", [F.asc("name")])
    assert tuples(first) == [("a", 1), ("b", 2), ("c", 3)]


def test_partial_rows_with_new_keys(spark):
    customer = small_sales(spark).customer
    rows = spark.range(5).select(
        "id", F.lit("Anita").alias("FirstName"), F.lit("Coats").alias("LastName")
    )
    keyed = assign_ids(rows, customer, "Id", [F.asc("id")], "new_id").select(
        F.col("new_id").alias("Id"), "FirstName", "LastName"
    )
    added = insert_rows(customer, keyed).filter("FirstName = 'Anita'")
    assert sorted(tuples(added)) == [(k, "Anita", "Coats", None, None, None) for k in range(6, 11)]


# --- publishing -----------------------------------------------------------------------


@pytest.fixture
def published(spark, tmp_path):
    """A product table published from its first snapshot."""
    name = "published_product"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    first = f"{tmp_path}/start"
    small_sales(spark).product.write.parquet(first)
    run_change(spark, name, str(tmp_path), "0", lambda old: old, first)
    yield name, str(tmp_path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_change_moves_the_table_to_a_new_snapshot(spark, published):
    name, base = published
    before = current_location(spark, name)
    run_change(spark, name, base, "1", lambda old: delete_rows(old, F.col("Id") == 5), before)
    assert {r.Id for r in spark.table(name).collect()} == {1, 2, 3, 4}
    assert current_location(spark, name) != before
    # The old snapshot is still there.
    assert spark.read.parquet(before).count() == 5


def test_a_repeated_change_gives_the_same_table(spark, published):
    name, base = published
    before = current_location(spark, name)
    row = spark.sql("SELECT 9 AS Id, 'New' AS ProductName, 1 AS SupplierId")

    def change(old):
        return insert_rows(old, row, PRODUCT.defaults)

    for _ in range(2):
        run_change(spark, name, base, "1", change, before)
        assert spark.table(name).count() == 6


def test_a_late_repeat_does_not_undo_a_later_change(spark, published):
    name, base = published
    first = current_location(spark, name)
    run_change(spark, name, base, "1", lambda old: delete_rows(old, F.col("Id") == 5), first)
    second = current_location(spark, name)
    run_change(spark, name, base, "2", lambda old: delete_rows(old, F.col("Id") == 4), second)
    with pytest.raises(ValueError, match="has moved on"):
        run_change(spark, name, base, "1", lambda old: old, first)
    assert {r.Id for r in spark.table(name).collect()} == {1, 2, 3}


def test_a_change_keeps_the_columns(spark, published):
    name, base = published
    with pytest.raises(ValueError, match="schema drift: Extra: not declared"):
        run_change(spark, name, base, "1", lambda old: old.withColumn("Extra", F.lit(1)))


def test_the_first_snapshot_must_be_given(spark, tmp_path):
    with pytest.raises(ValueError, match="first snapshot must be given"):
        run_change(spark, "no_such_table", str(tmp_path), "1", lambda old: old)


def test_a_failed_change_changes_nothing(spark, published):
    name, base = published
    before = current_location(spark, name)

    def change(old):
        return old.withColumn("UnitPrice", F.raise_error(F.lit("no")).cast("decimal(12,2)"))

    with pytest.raises(Exception, match="no"):
        run_change(spark, name, base, "1", change, before)
    assert current_location(spark, name) == before
    assert spark.table(name).count() == 5


def test_a_run_may_not_overwrite_what_it_reads(spark, published):
    name, base = published
    with pytest.raises(ValueError, match="would overwrite"):
        run_change(spark, name, base, "0", lambda old: old, f"{base}/snapshot-0")


# --- audit ----------------------------------------------------------------------------


def test_row_sets_become_a_log(spark):
    product = small_sales(spark).product
    log = row_sets_log(product.filter("Id = 1"), product.filter("Id IN (2, 4)"), stamp())
    assert log.columns == [*PRODUCT.schema.names, "updatedat", "operation"]
    assert {(r.Id, r.operation, r.updatedat) for r in log.collect()} == {
        (1, "INS", STAMP), (2, "DEL", STAMP), (4, "DEL", STAMP)
    }


def test_an_update_is_not_logged(spark):
    product = small_sales(spark).product
    changed = update_rows(product, {"ProductName": F.lit("x"), "UnitPrice": F.lit(None)})
    assert snapshot_log(product, changed, "Id", stamp()).count() == 0
    assert snapshot_log(product, product, "Id", stamp()).count() == 0
    empty = product.limit(0)
    assert {r.operation for r in snapshot_log(empty, product, "Id", stamp()).collect()} == {"INS"}
    assert {r.operation for r in snapshot_log(product, empty, "Id", stamp()).collect()} == {"DEL"}


def test_a_row_without_a_key_is_not_lost(spark):
    keyed = spark.createDataFrame([(1, "a")], "k int, name string")
    unkeyed = spark.createDataFrame([(1, "a"), (None, "b")], "k int, name string")

    def log(old, new):
        return as_set(snapshot_log(old, new, "k", stamp()).select("k", "name", "operation"))

    assert log(keyed, unkeyed) == {(None, "b", "INS")}
    assert log(unkeyed, keyed) == {(None, "b", "DEL")}
    assert log(unkeyed, unkeyed) == set()


@few_examples
@given(old=st.sets(st.integers(0, 30)), new=st.sets(st.integers(0, 30)))
def test_replaying_the_log_gives_the_new_keys(spark, old, new):
    def table(keys, text):
        return spark.createDataFrame([(k, text) for k in keys], "k int, name string")

    log = snapshot_log(table(old, "old"), table(new, "new"), "k", stamp())
    keys = set(old)
    for row in log.collect():
        if row.operation == "INS":
            assert row.k not in old and row.name == "new"
            keys.add(row.k)
        else:
            assert row.k not in new and row.name == "old"
            keys.remove(row.k)
    assert keys == new


def test_the_switch(spark, published):
    name, _ = published
    product = small_sales(spark).product
    log = row_sets_log(product, product.limit(0), stamp())
    switch = TableSwitch(spark)
    assert logged(log, switch, name).count() == 5
    switch.disable(name)
    assert logged(log, TableSwitch(spark), name).count() == 0
    assert logged(log, switch, "order").count() == 5
    switch.enable(name)
    assert switch.is_on(name)
    switch.disable_all([name])
    assert not switch.is_on(name)
    switch.enable_all([name])
    assert switch.is_on(name)


def test_log_files_are_read_by_operation(spark, tmp_path):
    product = small_sales(spark).product
    base = str(tmp_path)
    append_log(row_sets_log(product, product.limit(0), stamp()), base, "1")
    log = row_sets_log(product.limit(0), product.filter("Id < 3"), stamp())
    for _ in range(2):
        append_log(log, base, "2")
    again = read_log(spark, base, log.schema)
    counts = again.groupBy("operation").count().orderBy("operation")
    assert tuples(counts) == [("DEL", 2), ("INS", 5)]
    text = plan(again.filter("operation = 'DEL'"))
    assert "(operation" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_a_change_and_its_log_can_be_repeated(spark, published):
    name, base = published
    log_base = f"{base}/log"
    switch = TableSwitch(spark)
    row = spark.sql(
        "SELECT 9 AS Id, 'PRODUCT X' AS ProductName, 1 AS SupplierId, 1240 AS UnitPrice,"
        " '1' AS Package, 0 AS IsDiscontinued"
    )

    def insert(old):
        return insert_rows(old, row)

    def run(run_id, change):
        return run_audited_change(
            spark, name, base, run_id, change, "Id", log_base, stamp(), switch
        )

    # The first attempt at run 1 ends between the change and the log.
    run_change(spark, name, base, "1", insert)
    for _ in range(2):
        new = run("1", insert)
        assert spark.table(name).count() == 6
    schema = new.withColumns({"updatedat": stamp(), "operation": F.lit("")}).schema

    def log():
        rows = read_log(spark, log_base, schema).collect()
        return sorted((r.Id, r.operation) for r in rows)

    assert log() == [(9, "INS")]
    switch.disable(name)
    run("2", lambda old: delete_rows(old, F.col("Id") == 1))
    assert log() == [(9, "INS")]
    switch.enable(name)
    run("3", lambda old: delete_rows(old, F.col("ProductName") == "PRODUCT X"))
    assert log() == [(9, "DEL"), (9, "INS")]
    assert {r.Id for r in spark.table(name).collect()} == {2, 3, 4, 5}
