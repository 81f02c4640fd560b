"""The audit log fed by a stream of change rows.

``start_product_audit`` keeps the audit table itself: its columns, with ids that go on from batch to
batch. ``start_audit`` keeps rows of any shape without ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from saleswright.operators.audit import OPERATION, append_log, product_columns
from saleswright.operators.key_ranges import with_reserved_keys
from saleswright.sources.schemas import AUDIT, complete_rows
from saleswright.sources.tables import RUN


def read_changes(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    files: str = "*.parquet",
    files_per_batch: int = 1000,
) -> DataFrame:
    """Change rows from Parquet files as they appear in a folder; a batch's size is bounded."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", files)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def audit_rows(changes: DataFrame, operation: Column, stamp: Column) -> DataFrame:
    """Change rows as log rows: the row, its stamp and its operation."""
    return changes.withColumns({"updatedat": stamp, OPERATION: operation})


def start_audit(rows: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to the log, then stop; the next start goes on from there.

    The file sink lists each batch's files under the batch number, and readers of the log
    follow that list. So a batch that is run again after a failure is logged once, and files
    of a failed attempt are not read.
    """
    return (
        rows.writeStream.format("parquet")
        .partitionBy(OPERATION)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(log)
    )


def batch_run(batch: int) -> str:
    """The run that a batch writes; names of later batches sort behind."""
    return f"batch-{batch:012d}"


def audit_batch(rows: DataFrame, batch: int, log: str) -> None:
    """Write one batch of log rows (a product's columns, stamp and operation) as audit rows.

    A batch is a run of its own, with a folder of its own and a range of ids that is reserved before
    its rows are written. A batch that is run again finds its range and replaces its folder, so it
    adds nothing and gives the same ids. Ids go by product, operation and then all other columns;
    rows that are alike in all may swap theirs.
    """
    shaped = product_columns(rows)
    named = [f.name for f in AUDIT.schema.fields if f.name in shaped.columns]
    shaped = shaped.select(*named)
    first = ["productid", OPERATION]
    order = [F.asc_nulls_first(c) for c in [*first, *(c for c in named if c not in first)]]
    run = batch_run(batch)
    keyed = with_reserved_keys(shaped, log, run, AUDIT.key, order, lambda: 0)
    append_log(complete_rows(keyed, AUDIT.schema), log, run)


def start_product_audit(rows: DataFrame, log: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to the audit table at ``log``, then stop; the next start goes on from
    there. The log is read by ``read_log``, or by ``read_batches`` with each row's batch."""
    return (
        rows.writeStream.foreachBatch(lambda batch, number: audit_batch(batch, number, log))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_batches(spark: SparkSession, log: str) -> DataFrame:
    """The audit rows with ``batch``, the number of the batch that brought them. (batch, id) is a
    key, as is id alone."""
    stored = [f for f in AUDIT.schema.fields if f.name != OPERATION]
    folders = [StructField(RUN, StringType()), StructField(OPERATION, StringType())]
    rows = spark.read.schema(StructType([*stored, *folders])).parquet(log)
    number = F.regexp_extract(RUN, r"^batch-(\d+)$", 1).try_cast("long").alias("batch")
    return rows.select(number, *AUDIT.schema.names)
