"""The audit log: inserted and deleted rows, with a stamp and the operation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from saleswright.operators.changes import (
    Statement,
    content_folder,
    current_location,
    read_statement,
    run_change,
    same_place,
    set_table_property,
    statement_path,
    table_property,
)
from saleswright.operators.numbering import assign_ids
from saleswright.operators.rules import TableRules
from saleswright.session import scratch_path
from saleswright.sources.schemas import AUDIT, DELETED, INSERTED, TableSpec, complete_rows
from saleswright.sources.tables import RUN, quoted_name, write_run

OPERATION = "operation"


def row_sets_log(inserted: DataFrame, deleted: DataFrame, stamp: Column) -> DataFrame:
    """The log of one statement, from the rows it inserted and the rows it deleted."""
    marked = [
        rows.withColumns({"updatedat": stamp, OPERATION: F.lit(operation)})
        for rows, operation in ((inserted, INSERTED), (deleted, DELETED))
    ]
    return marked[0].unionByName(marked[1])


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys that only one of two snapshots holds, with the operation that explains it.

    All rows of a key are counted as one, in part by each task, so neither many rows of one
    key nor of none make pairs.
    """
    before = old.select(F.col(key).alias("_key"), F.lit(1).alias("_old"), F.lit(0).alias("_new"))
    after = new.select(F.col(key).alias("_key"), F.lit(0).alias("_old"), F.lit(1).alias("_new"))
    sides = before.unionAll(after).groupBy("_key").agg(
        F.max("_old").alias("_old"), F.max("_new").alias("_new")
    )
    return sides.filter("_old <> _new").select(
        "_key", F.when(F.col("_new") == 1, INSERTED).otherwise(DELETED).alias(OPERATION)
    )


def snapshot_log(old: DataFrame, new: DataFrame, key: str, stamp: Column) -> DataFrame:
    """The log of a change that something else made, from the table before and after it.

    A change of one's own knows its rows: see ``Statement``. Here a key only in ``new`` was
    inserted and one only in ``old`` was deleted. A row whose other columns changed is an update,
    which is not logged; nor is a row that replaces one of its key.

    Only keys are shuffled to find the changes. They are written to the shared folder, so that
    their size is known when the rows are fetched: few changes are broadcast, and the
    snapshots are then read without a shuffle; many are joined like any other table.
    """
    spark = old.sparkSession
    found = changed_keys(old, new, key)
    path = scratch_path(spark, "changed-keys")
    found.write.partitionBy(OPERATION).parquet(path)
    found = spark.read.schema(found.schema).parquet(path)

    def rows(snapshot: DataFrame, operation: str) -> DataFrame:
        keys = found.filter(F.col(OPERATION) == operation).select("_key")
        return snapshot.join(keys, snapshot[key].eqNullSafe(keys["_key"]), "left_semi")

    return row_sets_log(rows(new, INSERTED), rows(old, DELETED), stamp)


def product_columns(log: DataFrame) -> DataFrame:
    """A log of product rows under the audit table's names."""
    return log.withColumnsRenamed(
        {"Id": "productid", "ProductName": "productname", "Package": "package"}
    )


def product_audit(log: DataFrame, existing: DataFrame) -> DataFrame:
    """A log of product rows under the audit table's schema, with ids above the existing ones."""
    rows = product_columns(log)
    order = [F.asc("productid"), F.asc(OPERATION)]
    return complete_rows(assign_ids(rows, existing, AUDIT.key, order), AUDIT.schema)


def inserting(
    old: DataFrame | Statement, rows: DataFrame, spec: TableSpec | None = None
) -> Statement:
    """INSERT: all the rows are logged, whatever their keys."""
    return Statement.of(old).insert(rows, spec.defaults if spec else None)


def deleting(old: DataFrame | Statement, where: Column) -> Statement:
    """DELETE: the rows that the condition selects are logged."""
    return Statement.of(old).delete(where)


def updating(
    old: DataFrame | Statement, values: dict[str, Column], where: Column | None = None
) -> Statement:
    """UPDATE: not logged, but its rows are checked against the rules."""
    return Statement.of(old).update(values, where)


def both(first: Statement, then: Callable[[Statement], Statement]) -> Statement:
    """One change of two statements, each logged by its own rows."""
    return then(first)


class TableSwitch:
    """The audit switch as a property of each table, so that off in one job is off in the next.

    A table without the property is audited."""

    PROPERTY = "audit"

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def disable(self, table: str) -> None:
        set_table_property(self.spark, table, self.PROPERTY, "off")

    def enable(self, table: str) -> None:
        set_table_property(self.spark, table, self.PROPERTY, "on")

    def disable_all(self, tables: list[str]) -> None:
        for table in tables:
            self.disable(table)

    def enable_all(self, tables: list[str]) -> None:
        for table in tables:
            self.enable(table)

    def is_on(self, table: str) -> bool:
        if not self.spark.catalog.tableExists(quoted_name(table)):
            return True
        return table_property(self.spark, table, self.PROPERTY) != "off"


def logged(log: DataFrame, switch: TableSwitch, table: str) -> DataFrame:
    """The log of a change, or no rows if the table's audit is switched off just now."""
    return log if switch.is_on(table) else log.limit(0)


def append_log(log: DataFrame, base: str, run: str) -> None:
    """Append one run's log, in a folder per operation. A repeated run replaces its own."""
    write_run(log, base, run, (OPERATION,))


def read_log(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """The whole log. A filter on the operation reads that operation's folders only."""
    stored = [f for f in schema.fields if f.name != OPERATION]
    with_folders = StructType(
        [*stored, StructField(RUN, StringType()), StructField(OPERATION, StringType())]
    )
    return spark.read.schema(with_folders).parquet(base).select(*schema.names)


#: Table property: the run that made the current snapshot, and whether it is logged.
RUN_AUDITED = "run_audited"


def run_audited_change(
    spark: SparkSession,
    table: str,
    base: str,
    run: str,
    change: Callable[[DataFrame], DataFrame | Statement],
    key: str,
    log_base: str,
    stamp: Column,
    switch: TableSwitch,
    previous: str | None = None,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    rules: TableRules | None = None,
) -> DataFrame:
    """Change a table, then log the change under the same run.

    A change that returns a ``Statement`` is logged by the rows it has written; of one that returns
    the new content alone, the snapshots are compared by ``key``. ``change`` is called once, and not
    at all if the run is already committed. ``shape`` makes stored rows of log rows, such as those of
    the audit table. ``rules`` are checked before the commit.

    Whether the run is logged is decided when it commits, and noted with the commit. A run that
    failed in between can be repeated: it finds the change done and does as was decided.
    """
    yes, no = f"yes: {run}", f"no: {run}"
    decision = yes if switch.is_on(table) else no
    notes = {RUN_AUDITED: decision}
    old, new = run_change(spark, table, base, run, change, previous, notes, rules)
    noted = table_property(spark, table, RUN_AUDITED)
    if (noted if noted in (yes, no) else decision) == yes:
        path = statement_path(base, run)
        if same_place(current_location(spark, table), content_folder(path)):
            made = read_statement(spark, path, old.schema)
            log = row_sets_log(made.inserted, made.deleted, stamp)
        else:
            log = snapshot_log(old, new, key, stamp)
        append_log(shape(log) if shape else log, log_base, run)
    return new


def product_log(
    spark: SparkSession, log_base: str, run: str
) -> Callable[[DataFrame], DataFrame]:
    """The shape of a product change's log: the audit table's columns, with ids above those that
    other runs of the log have."""

    def shape(log: DataFrame) -> DataFrame:
        none = spark.sql("SELECT CAST(NULL AS BIGINT) AS id").limit(0)
        try:
            stored = spark.read.option("basePath", log_base).parquet(log_base)
        except AnalysisException:  # no run has been logged yet
            stored = none.withColumn(RUN, F.lit(""))
        return product_audit(log, stored.filter(F.col(RUN) != run).select("id"))

    return shape
