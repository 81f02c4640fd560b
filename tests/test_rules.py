"""Rules on changes: what stops a run, what does not, and row sets that agree with the content."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import small_sales, tuples
from saleswright.operators.audit import TableSwitch, read_log, run_audited_change, updating
from saleswright.operators.changes import (
    Statement,
    current_location,
    delete_rows,
    read_statement,
    run_change,
    statement_path,
)
from saleswright.operators.rules import BrokenRules, TableRules
from saleswright.sources.schemas import CUSTOMER, ORDER, PRODUCT, SUPPLIER


def stamp():
    return F.lit("2024-01-02T03:04:05").cast("timestamp_ntz")


@pytest.fixture
def published(spark, tmp_path):
    """Publish one of the small tables: its name, base folder and rules."""
    made = []

    def publish(spec):
        tables = small_sales(spark).by_name()
        name, base = f"ruled_{spec.name}", f"{tmp_path}/{spec.name}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        tables[spec.name].write.parquet(f"{base}/first")
        run_change(spark, name, base, "0", lambda old: old, f"{base}/first")
        made.append(name)
        return name, base, TableRules.declared(spec, tables)

    yield publish
    for name in made:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


BROKEN = [
    (SUPPLIER, lambda s: s.delete(F.col("Id") == 1), {"FK_PRODUCT_REFERENCE_SUPPLIER": 2}),
    (CUSTOMER, lambda s: s.delete(), {"FK_ORDER_REFERENCE_CUSTOMER": 5}),
    (ORDER, lambda s: s.update({"Id": F.lit(9)}, F.col("Id") == 1), {"FK_ORDERITE_REFERENCE_ORDER": 1}),
    (CUSTOMER, lambda s: s.update({"FirstName": F.lit(None)}, F.col("Id") < 3), {"FirstName is null": 2}),
    (CUSTOMER, lambda s: s.update({"Phone": F.repeat(F.lit("1"), F.lit(21))}), {"Phone over 20": 5}),
    (PRODUCT, lambda s: s.update({"SupplierId": F.lit(99)}, F.col("Id") > 3), {"FK_PRODUCT_REFERENCE_SUPPLIER": 2}),
    (PRODUCT, lambda s: s.update({"Id": F.col("Id") % 2}), {"Id repeated": 2, "FK_ORDERITE_REFERENCE_PRODUCT": 3}),
]


@pytest.mark.parametrize("spec, change, faults", BROKEN)
def test_a_broken_rule_stops_the_run(spark, published, spec, change, faults):
    name, base, rules = published(spec)
    before = current_location(spark, name)
    with pytest.raises(BrokenRules) as stopped:
        run_change(spark, name, base, "1", lambda old: change(Statement.of(old)), rules=rules)
    assert stopped.value.faults == faults
    assert current_location(spark, name) == before and spark.table(name).count() == 5 - (spec is SUPPLIER) * 2


def test_inserted_rows_are_checked(spark, published):
    name, base, rules = published(PRODUCT)
    rows = spark.createDataFrame(
        [(1, "again", 1), (7, "lost", 99), (8, None, 1), (None, "no key", 2), (9, "x" * 51, 2), (9, "y", None)],
        "Id long, ProductName string, SupplierId long",
    )
    with pytest.raises(BrokenRules) as stopped:
        run_change(spark, name, base, "1", lambda old: Statement.of(old).insert(rows, PRODUCT.defaults), rules=rules)
    assert stopped.value.faults == {
        "Id repeated": 2,
        "Id is null": 1,
        "ProductName is null": 1,
        "ProductName over 50": 1,
        "SupplierId is null": 1,
        "FK_PRODUCT_REFERENCE_SUPPLIER": 1,
    }


def test_changes_that_keep_the_rules_are_committed(spark, published):
    name, base, rules = published(CUSTOMER)
    # Customers 3 and 5 have no orders; a key that is deleted and comes back is not gone.
    change = lambda old: (
        Statement.of(old)
        .insert(old.filter("Id = 1").select((F.col("Id") + 9).alias("Id"), "FirstName", "LastName"))
        .delete(F.col("Id").isin(3, 5, 2))
        .update({"City": F.upper("City")}, F.col("Id") == 4)
        .insert(old.filter("Id = 2"))
    )
    _, new = run_change(spark, name, base, "1", change, rules=rules)
    assert sorted((r.Id, r.City) for r in new.collect()) == [
        (1, "São Paulo"), (2, "Sao Paulo"), (4, "LONDON"), (10, None)
    ]
    made = read_statement(spark, statement_path(base, "1"), CUSTOMER.schema)
    sets = {s: sorted(r.Id for r in made.row_set(s).collect()) for s in ("inserted", "deleted", "before", "after")}
    assert sets == {"inserted": [2, 10], "deleted": [2, 3, 5], "before": [4], "after": [4]}


def test_faults_that_were_there_before_stop_nothing(spark, published, tmp_path):
    """Only what a statement touches is tested."""
    name, base, rules = published(PRODUCT)
    rules = TableRules(rules.spec, {"Supplier": small_sales(spark).supplier.filter("Id = 1")}, rules.children)
    _, new = run_change(spark, name, base, "1", lambda old: Statement.of(old).update({"Package": F.lit("x")}, F.col("SupplierId") == 1), rules=rules)
    assert new.filter("Package = 'x'").count() == 2
    with pytest.raises(BrokenRules):
        run_change(spark, name, base, "2", lambda old: Statement.of(old).update({"Package": F.lit("x")}), rules=rules)


def test_a_change_without_row_sets_is_checked_as_a_whole(spark, published):
    name, base, rules = published(SUPPLIER)
    with pytest.raises(BrokenRules) as stopped:
        run_change(spark, name, base, "1", lambda old: delete_rows(old, F.col("Id") == 2), rules=rules)
    assert stopped.value.faults == {"FK_PRODUCT_REFERENCE_SUPPLIER": 2}


def test_content_and_log_come_from_one_evaluation(spark, tmp_path):
    """A condition and values that change whenever they are evaluated."""
    name, base = "random_rows", f"{tmp_path}/t"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.range(2000).select(F.col("id").alias("Id"), F.lit("old").alias("v")).write.parquet(f"{base}/first")
    calls = []

    def change(old):
        calls.append(1)
        rows = spark.range(5000, 5500).select(F.col("id").alias("Id"), F.uuid().alias("v"))
        return Statement.of(old).delete(F.rand() < 0.5).insert(rows).update({"v": F.uuid()}, F.rand() < 0.3)

    for _ in range(2):
        new = run_audited_change(spark, name, base, "1", change, "Id", f"{base}/log", stamp(), TableSwitch(spark), f"{base}/first")
    assert len(calls) == 1
    log = read_log(spark, f"{base}/log", new.withColumns({"updatedat": stamp(), "operation": F.lit("")}).schema)
    gone = {r.Id for r in log.filter("operation = 'DEL'").collect()}
    left = {r.Id: r.v for r in new.collect()}
    assert 0 < len(gone) < 2000 and gone == set(range(2000)) - set(left)
    made = read_statement(spark, statement_path(base, "1"), new.schema)
    for r in made.row_set("after").collect():
        assert left[r.Id] == r.v
    updated = {r.Id for r in made.row_set("after").collect()}
    added = {r.Id: r.v for r in log.filter("operation = 'INS'").collect()}
    assert set(added) == set(range(5000, 5500))
    assert all(left[k] == v for k, v in added.items() if k not in updated)
    spark.sql(f"DROP TABLE {name}")


def test_updates_are_not_logged_and_keep_types(spark, published):
    name, base, rules = published(PRODUCT)
    change = lambda old: updating(old, {"UnitPrice": F.lit(5)}, F.col("Id") == 1)
    new = run_audited_change(spark, name, base, "1", change, "Id", f"{base}/log", stamp(), TableSwitch(spark), rules=rules)
    assert new.schema["UnitPrice"].dataType == PRODUCT.schema["UnitPrice"].dataType
    assert read_log(spark, f"{base}/log", new.withColumns({"updatedat": stamp(), "operation": F.lit("")}).schema).count() == 0
    with pytest.raises(ValueError, match="columns not in the table"):
        updating(new, {"Nothing": F.lit(1)})


def test_an_empty_table_stays_a_table(spark, published):
    name, base, _ = published(PRODUCT)
    _, new = run_change(spark, name, base, "1", lambda old: Statement.of(old).delete())
    assert new.count() == 0 and spark.table(name).count() == 0
    assert set(new.columns) == set(PRODUCT.schema.names)


def test_a_delete_shuffles_only_the_changed_keys(spark, published, set_conf):
    name, base, rules = published(CUSTOMER)
    made = Statement.of(spark.table(name)).delete(F.col("Id") == 3).written(f"{base}/w")
    text = rules.faults_of(made)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert Counter(tuples(made.deleted)) == Counter(tuples(small_sales(spark).customer.filter("Id = 3")))
