"""Reading, loading, copying and staging tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from saleswright.functions.scalar import stamp_from_text
from saleswright.sources.schemas import TableSpec, complete_rows, now, require_schema

RUN = "run_id"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of a folder, with the columns that its files have now."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_declared(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """A Parquet table, loaded in runs or not, that must have the declared columns and types."""
    return require_schema(spark.read.parquet(path).drop(RUN), spec.schema)


def create_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """An empty catalogue table with the declared types, text limits and defaults.

    Inserts of SQL then fill columns left out and refuse a text that is too long. Keys,
    references and NOT NULL are not enforced by Parquet tables: see ``operators.quality``.
    """
    columns = []
    for f in spec.schema.fields:
        kind = f.dataType.simpleString()
        if f.name in spec.text_limits:
            kind = f"VARCHAR({spec.text_limits[f.name]})"
        column = f"{quoted_name(f.name)} {kind}"
        if f.name in spec.defaults:
            default = spec.defaults[f.name]
            column += " DEFAULT " + ("localtimestamp()" if default is now else str(default))
        columns.append(column)
    name = quoted_name(spec.name)
    spark.sql(f"CREATE TABLE {name} ({', '.join(columns)}) USING parquet")
    return spark.table(name)


# --- runs: one folder per job run, so that a repeated run replaces itself -------------


def write_run(df: DataFrame, base: str, run: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append ``df`` to the table at ``base`` as one run. Writing a run again replaces it."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{base}/{RUN}={run}")


def read_runs(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """All runs written to ``base``, without the run column."""
    with_run = StructType([*schema.fields, StructField(RUN, StringType())])
    return spark.read.schema(with_run).parquet(base).select(*schema.names)


def _from_text(f: StructField) -> Column:
    """A text column in its declared type; text that does not fit stops the job."""
    text = F.col(f.name)
    value = text.cast(f.dataType)
    if isinstance(f.dataType, TimestampNTZType):
        value = F.when(text.rlike("^[A-Za-z]"), stamp_from_text(text)).otherwise(value)
    misfit = F.raise_error(F.concat(F.lit(f"{f.name} cannot hold "), text)).cast(f.dataType)
    return F.when(text.isNotNull() & value.isNull(), misfit).otherwise(value).alias(f.name)


def load_rows(rows: DataFrame, spec: TableSpec, target: str, load: str) -> DataFrame:
    """Append rows of any source, such as ``spark.read.jdbc``, and return the table.

    Rows bring their own keys; columns they lack take their defaults, or NULL where none is
    declared. A repeated load replaces itself.
    """
    write_run(complete_rows(rows, spec.schema, spec.defaults), target, load)
    return read_runs(rows.sparkSession, target, spec.schema)


def bulk_load(
    spark: SparkSession,
    source: str,
    spec: TableSpec,
    target: str,
    load: str,
    given: list[str] | None = None,
    file_format: str = "csv",
    **options: str,
) -> DataFrame:
    """Load files as ``load_rows`` does, and return the table.

    ``given`` names the columns that the files hold, in their order. In CSV and JSON a flag
    may be 0 or 1, and a stamp may be in ISO form or such as ``Jul  4 2012 12:00:00:000AM``.
    A row that does not fit its types stops the load.
    """
    fields = [spec.schema[name] for name in given or spec.schema.names]
    if file_format in ("csv", "json"):
        as_text = StructType([StructField(f.name, StringType()) for f in fields])
        reader = spark.read.format(file_format).schema(as_text).option("mode", "FAILFAST")
        rows = reader.options(**options).load(source).select(*[_from_text(f) for f in fields])
    else:
        reader = spark.read.format(file_format).schema(StructType(fields))
        rows = reader.options(**options).load(source)
    return load_rows(rows, spec, target, load)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


# --- copies ---------------------------------------------------------------------------


def select_into(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as a new table and read it back. An existing table is an error."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def select_into_table(df: DataFrame, table: str, path: str) -> DataFrame:
    """Write ``df`` as a new named table with its files at ``path``, and read it back."""
    df.write.mode("errorifexists").option("path", path).saveAsTable(quoted_name(table))
    return df.sparkSession.table(quoted_name(table))


def drop_table(spark: SparkSession, table: str) -> None:
    """Forget a named table. Files at a path of their own stay where they are."""
    spark.sql(f"DROP TABLE {quoted_name(table)}")


def empty_table(df: DataFrame, path: str) -> DataFrame:
    """The truncated table: a new snapshot with the schema and no rows."""
    return select_into(df.limit(0), path)


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and hash sums that do not depend on row order, to compare two copies."""
    row_hash = F.xxhash64(*df.columns)
    return df.agg(
        F.count("*").alias("n"),
        F.sum(row_hash.cast("decimal(20,0)")).alias("hash_sum"),
        F.bit_xor(row_hash).alias("hash_xor"),
    )


# --- staging --------------------------------------------------------------------------


def stage_for_session(df: DataFrame, name: str) -> DataFrame:
    """Name a result for this session only."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def stage_for_all(df: DataFrame, name: str) -> DataFrame:
    """Name a result for all sessions of the application."""
    df.createOrReplaceGlobalTempView(name)
    return df.sparkSession.table(f"global_temp.{name}")


def drop_staged_for_all(spark: SparkSession, name: str) -> bool:
    return spark.catalog.dropGlobalTempView(name)


def quoted_name(*parts: str) -> str:
    """A table name whose parts cannot be read as anything but names."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def read_named_table(spark: SparkSession, *parts: str) -> DataFrame:
    """A table named at run time. The name is bound as a name, never pasted into SQL."""
    return spark.sql("SELECT * FROM IDENTIFIER(:name)", args={"name": quoted_name(*parts)})


def named_column(df: DataFrame, name: str) -> Column:
    """A column named at run time, which must be a plain column of ``df``."""
    if name not in df.columns:
        raise ValueError(f"no column {name!r}")
    return df[quoted_name(name)]
