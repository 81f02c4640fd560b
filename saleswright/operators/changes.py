"""Row changes as new snapshots: a table is never changed in place.

Each operator takes a table and returns the changed table. ``run_change`` writes the result
beside the old one and then moves the table to it; a run that fails before that has
changed nothing.

A ``Statement`` is a change that also knows its rows: those it inserts, deletes, and updates, before
and after. Content and row sets are one DataFrame, evaluated and written once, so they always agree;
rules are then checked on the rows that changed, and the audit log is made of them.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from saleswright.operators.rules import TableRules
from saleswright.sources.schemas import complete_rows, require_schema
from saleswright.sources.tables import quoted_name


def update_rows(df: DataFrame, values: dict[str, Column], where: Column | None = None) -> DataFrame:
    """Set columns where ``where`` is TRUE, or on all rows if it is not given.

    All new values and the condition see the old row. A NULL condition leaves the row as it is.
    """
    unknown = [name for name in values if name not in df.columns]
    if unknown:
        raise ValueError(f"columns not in the table: {unknown}")
    where = F.lit(True) if where is None else where

    def column(name: str) -> Column:
        if name not in values:
            return F.col(name)
        new = values[name].cast(df.schema[name].dataType)
        return F.when(where, new).otherwise(F.col(name)).alias(name)

    return df.select(*[column(name) for name in df.columns])


def selected(where: Column) -> Column:
    """TRUE where the condition is TRUE, and FALSE where it is FALSE or NULL."""
    return F.coalesce(where, F.lit(False))


def delete_rows(df: DataFrame, where: Column | None = None) -> DataFrame:
    """Remove the rows where ``where`` is TRUE, or all rows if it is not given."""
    return df.limit(0) if where is None else df.filter(~selected(where))


def insert_rows(
    df: DataFrame, rows: DataFrame, defaults: dict[str, object] | None = None
) -> DataFrame:
    """Add rows, matched by column name; a column left out takes its default, or NULL."""
    return df.unionByName(complete_rows(rows, df.schema, defaults))


def insert_through_view(
    df: DataFrame, rows: DataFrame, view: Column, defaults: dict[str, object] | None = None
) -> DataFrame:
    """Add rows to the table under a view, and tell which rows the view then shows."""
    return insert_rows(df, rows, defaults).withColumn("visible", selected(view))


def delete_through_view(df: DataFrame, view: Column, where: Column | None = None) -> DataFrame:
    """Remove the rows that the view shows and ``where`` selects."""
    return delete_rows(df, view if where is None else view & where)


# --- statements -----------------------------------------------------------------------

ROW_SET = "row_set"
#: The row sets of a statement: what the table holds after it, and the rows it changed.
CONTENT, INSERTED, DELETED, BEFORE, AFTER = "content", "inserted", "deleted", "before", "after"


class Statement:
    """What a change makes of a table, as rows marked with the set they belong to.

    ``insert``, ``update`` and ``delete`` can follow one another; each sees the content that the
    ones before have left, and adds its rows to the sets.
    """

    def __init__(self, rows: DataFrame) -> None:
        self.rows = rows
        self.columns = [c for c in rows.columns if c != ROW_SET]

    @staticmethod
    def of(table: DataFrame | Statement) -> Statement:
        """A statement that has changed nothing yet."""
        if isinstance(table, Statement):
            return table
        return Statement(table.withColumn(ROW_SET, F.lit(CONTENT)))

    def insert(self, rows: DataFrame, defaults: dict[str, object] | None = None) -> Statement:
        """INSERT: columns left out take their defaults, or NULL."""
        added = complete_rows(rows, self.rows.select(*self.columns).schema, defaults)
        sets = F.explode(F.array(F.lit(CONTENT), F.lit(INSERTED)))
        return Statement(self.rows.unionByName(added.withColumn(ROW_SET, sets)))

    def update(self, values: dict[str, Column], where: Column | None = None) -> Statement:
        """UPDATE as ``update_rows`` does it."""
        hit = self._in_content(F.lit(True) if where is None else where)
        old = F.struct(*[F.col(c) for c in self.columns])
        kinds = StructType([StructField(c, self.rows.schema[c].dataType) for c in self.columns])
        unknown = [name for name in values if name not in self.columns]
        if unknown:
            raise ValueError(f"columns not in the table: {unknown}")
        new = F.struct(
            *[values[c].cast(kinds[c].dataType).alias(c) if c in values else F.col(c) for c in self.columns]
        )

        def entry(name: Column, row: Column) -> Column:
            return F.struct(name.alias("set"), row.cast(kinds).alias("row"))

        made = [(CONTENT, new), (BEFORE, old), (AFTER, new)]
        changed = F.array(*[entry(F.lit(name), row) for name, row in made])
        entries = F.when(hit, changed).otherwise(F.array(entry(F.col(ROW_SET), old)))
        each = self.rows.select(F.explode(entries).alias("e"))
        return Statement(each.select("e.row.*", F.col("e.set").alias(ROW_SET)))

    def delete(self, where: Column | None = None) -> Statement:
        """DELETE of the rows where ``where`` is TRUE, or of all."""
        hit = self._in_content(F.lit(True) if where is None else where)
        moved = F.when(hit, F.lit(DELETED)).otherwise(F.col(ROW_SET))
        return Statement(self.rows.withColumn(ROW_SET, moved))

    def without(self, *columns: str) -> Statement:
        """Without columns that only a condition needed."""
        return Statement(self.rows.drop(*columns))

    def row_set(self, name: str) -> DataFrame:
        return self.rows.filter(F.col(ROW_SET) == name).select(*self.columns)

    @property
    def content(self) -> DataFrame:
        return self.row_set(CONTENT)

    @property
    def inserted(self) -> DataFrame:
        return self.row_set(INSERTED)

    @property
    def deleted(self) -> DataFrame:
        return self.row_set(DELETED)

    def written(self, path: str) -> Statement:
        """The same, written once to ``path`` with a folder for each set."""
        spark, schema = self.rows.sparkSession, self.rows.schema
        self.rows.write.mode("overwrite").partitionBy(ROW_SET).parquet(path)
        # The content is read by its own folder, which must be there even without rows.
        plain = StructType([StructField(c, schema[c].dataType) for c in self.columns])
        spark.createDataFrame([], plain).write.mode("append").parquet(content_folder(path))
        return Statement(spark.read.schema(schema).parquet(path))

    def _in_content(self, where: Column) -> Column:
        return (F.col(ROW_SET) == CONTENT) & selected(where)


def content_folder(path: str) -> str:
    return f"{path}/{ROW_SET}={CONTENT}"


def read_statement(spark: SparkSession, path: str, schema: StructType) -> Statement:
    """A statement that ``written`` has left at ``path``, over a table with ``schema``."""
    return Statement(
        spark.read.schema(StructType([*schema.fields, StructField(ROW_SET, StringType())])).parquet(path)
    )


# --- publishing -----------------------------------------------------------------------

PREVIOUS = "previous_snapshot"


def current_location(spark: SparkSession, table: str) -> str | None:
    """Folder of a table's current snapshot, or None if there is no such table."""
    if not spark.catalog.tableExists(quoted_name(table)):
        return None
    detail = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_name(table)}")
    return detail.filter(F.col("col_name") == "Location").first()["data_type"]


def table_property(spark: SparkSession, table: str, key: str) -> str | None:
    properties = spark.sql(f"SHOW TBLPROPERTIES {quoted_name(table)}")
    row = properties.filter(F.col("key") == key).first()
    return row and row["value"]


def set_table_property(spark: SparkSession, table: str, key: str, value: str) -> None:
    spark.sql(
        f"ALTER TABLE {quoted_name(table)} SET TBLPROPERTIES ({_text(key)} = {_text(value)})"
    )


def _previous_location(spark: SparkSession, table: str) -> str:
    """Folder of the snapshot that a table's current one was made from."""
    return table_property(spark, table, PREVIOUS)


def same_place(one: str, other: str) -> bool:
    a, b = urlparse(one), urlparse(other)
    return (a.netloc, a.path.rstrip("/")) == (b.netloc, b.path.rstrip("/"))


def _text(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish(
    spark: SparkSession,
    table: str,
    location: str,
    previous: str,
    notes: dict[str, str] | None = None,
) -> None:
    """Make the snapshot at ``location`` the table's content, and note what it was made from.

    A table that is not at ``previous`` any more is left alone: another run has changed it while
    this one wrote, and would be undone. The catalogue cannot compare and set in one step, so
    there must be one writer per table; this finds a second one that came in between.
    """
    name = quoted_name(table)
    noted = {PREVIOUS: previous, **(notes or {})}
    note = f"TBLPROPERTIES ({', '.join(f'{_text(k)} = {_text(v)}' for k, v in noted.items())})"
    current = current_location(spark, table)
    if current and not same_place(current, previous):
        raise ValueError(f"{table} has moved on to {current}")
    if current:
        spark.sql(f"ALTER TABLE {name} SET {note}")
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(location)}")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {_text(location)} {note}")


def statement_path(base: str, run: str) -> str:
    """Where a run writes the row sets of its statement."""
    return f"{base}/statement-{run}"


def run_change(
    spark: SparkSession,
    table: str,
    base: str,
    run: str,
    change: Callable[[DataFrame], DataFrame | Statement],
    previous: str | None = None,
    notes: dict[str, str] | None = None,
    rules: TableRules | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Change a table in one repeatable run, and return its old and new content.

    The run reads the snapshot ``previous``, or else the table's current one, and writes the
    changed rows to its own folder; moving the table there is the commit. A run that is
    already committed is not done again. A table that another run has moved on from
    ``previous`` is left alone.

    ``rules`` are checked before the commit, and a broken one ends the run: those of a
    ``Statement`` on the rows it changed, those of any other change on its whole result.
    """
    places = [f"{base}/snapshot-{run}", content_folder(statement_path(base, run))]
    if previous and any(same_place(place, previous) for place in places):
        raise ValueError(f"run {run!r} would overwrite the snapshot it reads")
    current = current_location(spark, table)
    done = [place for place in places if current and same_place(current, place)]
    if done:
        location = done[0]
        previous = _previous_location(spark, table)
    else:
        if current and previous and not same_place(current, previous):
            raise ValueError(f"{table} has moved on to {current}")
        previous = previous or current
        if previous is None:
            raise ValueError(f"there is no table {table}, so the first snapshot must be given")
        old = spark.read.parquet(previous)
        made = change(old)
        if isinstance(made, Statement):
            location = places[1]
            require_schema(made.content, old.schema)
            made = made.written(statement_path(base, run))
            if rules:
                rules.require(rules.faults_of(made))
        else:
            location = places[0]
            require_schema(made, old.schema).write.mode("overwrite").parquet(location)
            if rules:
                rules.require(rules.faults_between(old, spark.read.parquet(location)))
        publish(spark, table, location, previous, notes)
    return spark.read.parquet(previous), spark.read.parquet(location)
